"""Property values, privacy, gates and small text rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..fixtures import sql
from ..functions import jsonpaths, privacy, values
from ..functions.urls import ATTRIBUTION_KEYS, deep_link_properties, extract_attribution, host_of, is_self_request, project_push
from ..functions.wire import idempotency_key, user_slot
from ..operators import gates
from .registry import query

_EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
_CARD = r"\b(?:\d[ \-]*?){13,19}\b"


def _scrub_sql(expr: str) -> str:
    return f"regexp_replace(regexp_replace({expr}, '{_EMAIL}', '<email>', 'g'), '{_CARD}', '<card>', 'g')"


_CUT = "CASE WHEN length({0}) > 1024 THEN substring({0}, 1, 1023) || '…' ELSE {0} END"

_DOC_BAG_SQL = """
    bags AS (SELECT doc_id, text, lang, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS source,
             CASE doc_id % 10 WHEN 0 THEN 'NaN'::DOUBLE WHEN 1 THEN 'Infinity'::DOUBLE WHEN 2 THEN '-Infinity'::DOUBLE
                  ELSE n_chars * 0.5 END AS score FROM documents)"""


def _doc_bag(spark, sf):
    score = (
        F.when(F.col("doc_id") % 10 == 0, float("nan"))
        .when(F.col("doc_id") % 10 == 1, float("inf"))
        .when(F.col("doc_id") % 10 == 2, float("-inf"))
        .otherwise(F.col("n_chars") * 0.5)
    )
    source = F.when(F.col("doc_id") % 3 != 0, F.col("source"))
    return fx.documents(spark, sf).select(
        "doc_id",
        F.struct(
            F.create_map(F.lit("text"), "text", F.lit("source"), source).alias("texts"),
            F.array("lang", source).alias("tags"),
            score.alias("score"),
        ).alias("bag"),
    )


@query(
    "sanitize_properties",
    f"""WITH {_DOC_BAG_SQL} SELECT doc_id, {_CUT.format('text')} AS text,
        CASE WHEN source IS NULL THEN 'text' ELSE 'source,text' END AS kept_keys, 2 AS n_tags,
        CASE WHEN isfinite(score) THEN score END AS score FROM bags""",
)
def _sanitize(spark, sf):
    df = _doc_bag(spark, sf)
    clean = df.select("doc_id", values.sanitize(F.col("bag"), df.schema["bag"].dataType).alias("c"))
    return clean.select(
        "doc_id",
        F.col("c.texts")["text"].alias("text"),
        F.array_join(F.array_sort(F.map_keys("c.texts")), ",").alias("kept_keys"),
        F.size("c.tags").alias("n_tags"),
        F.col("c.score").alias("score"),
    )


@query(
    "sanitize_free_json",
    f"""WITH {_DOC_BAG_SQL} SELECT doc_id, {_CUT.format('text')} AS text, source,
        CASE WHEN length(text) > 1024 THEN 'text:truncated_string,list[1]:truncated_string' ELSE '' END AS warnings
        FROM bags""",
)
def _sanitize_json(spark, sf):
    bag = F.to_json(
        F.struct(
            "text",
            F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source"),
            F.array("lang", "text").alias("list"),
        ),
        {"ignoreNullFields": "false"},
    )
    out = fx.documents(spark, sf).select("doc_id", values.sanitize_json(bag).alias("s"))
    return out.select(
        "doc_id",
        F.get_json_object("s.properties", "$.text").alias("text"),
        F.get_json_object("s.properties", "$.source").alias("source"),
        F.array_join(F.transform("s.warnings", lambda w: F.concat_ws(":", w["key"], w["kind"])), ",").alias("warnings"),
    )


# Bags as they come: half a surrogate pair, no JSON, no object, numbers that are none, nesting without end.
_POISON = (
    "case doc_id % 8 when 0 then concat('{\"a\": \"\\\\ud83d x\", \"n\": ', doc_id, '}') when 1 then concat('{broken ', doc_id) when 2 then concat('[', doc_id, ']') "
    "when 3 then concat('{\"n\": NaN, \"m\": [Infinity, ', doc_id, ']}') when 4 then concat(repeat('[', 20000 + doc_id), repeat(']', 20000 + doc_id)) "
    "when 5 then concat(repeat('{\"d\": ', 60), doc_id, repeat('}', 60)) when 6 then null else concat('{\"n\": ', doc_id, '}') end"
)


@query(
    "sanitize_poisoned_json",
    """SELECT doc_id, CASE doc_id % 8 WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'not_an_object' WHEN 4 THEN 'too_deep' END AS error,
         CASE WHEN doc_id % 8 IN (0, 7) THEN doc_id END AS n, CASE WHEN doc_id % 8 = 0 THEN '� x' END AS a, CASE WHEN doc_id % 8 = 3 THEN doc_id END AS m,
         CASE doc_id % 8 WHEN 3 THEN 'n:not_finite,m[0]:not_finite' WHEN 5 THEN 'd:depth_exceeded' ELSE '' END AS warnings,
         md5(CASE doc_id % 8 WHEN 0 THEN '{"a": "� x", "n": ' || doc_id || '}' WHEN 1 THEN '{broken ' || doc_id WHEN 2 THEN '[' || doc_id || ']'
           WHEN 3 THEN '{"n": null, "m": [null, ' || doc_id || ']}' WHEN 4 THEN repeat('[', 20000 + doc_id) || repeat(']', 20000 + doc_id)
           WHEN 5 THEN repeat('{"d": ', 60) || doc_id || repeat('}', 60) WHEN 7 THEN '{"n": ' || doc_id || '}' END) AS scrubbed FROM documents""",
)
def _poisoned(spark, sf):
    bags = fx.documents(spark, sf).select("doc_id", F.expr(_POISON).alias("j"))
    out = bags.select("doc_id", values.sanitize_json("j").alias("s"), privacy.scrub_pii_json()("j").alias("j"))
    return out.select(
        "doc_id",
        "s.error",
        F.get_json_object("s.properties", "$.n").cast("bigint").alias("n"),
        F.get_json_object("s.properties", "$.a").alias("a"),
        F.get_json_object("s.properties", "$.m[1]").cast("bigint").alias("m"),
        F.array_join(F.transform("s.warnings", lambda w: F.concat_ws(":", w["key"], w["kind"])), ",").alias("warnings"),
        F.md5("j").alias("scrubbed"),
    )


def _bag_nodes(spark, sf, max_depth):
    """The paths of each document's bag as free JSON, and the document's id."""
    who = F.struct("text", F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source"), F.col("lang").alias("Email"))
    bag = F.struct(who.alias("user"), "n_chars", F.array("lang", "text").alias("list"), F.array(F.struct(F.lit("x").alias("password_hash"))).alias("login"))
    bags = fx.documents(spark, sf).select("doc_id", F.to_json(bag, {"ignoreNullFields": "false"}).alias("bag"))
    return jsonpaths.with_json_nodes(bags, "bag", "nodes", max_depth)


@query(
    "free_json_warnings",
    """SELECT doc_id, unnest(['text', 'list[1]']) AS key, 'truncated_string' AS kind FROM documents WHERE length(text) > 1024""",
)
def _json_warnings(spark, sf):
    rows = _bag_nodes(spark, sf, values.MAX_DEPTH).select("doc_id", F.explode(jsonpaths.json_warnings(F.col("nodes"))).alias("w"))
    return rows.select("doc_id", "w.key", "w.kind")


@query(
    "scrub_json_paths",
    f"""WITH d AS (SELECT doc_id, lang, source, n_chars, {_scrub_sql('text')} AS text FROM documents), leaf(path) AS (VALUES ('/user/text'), ('/user/source'),
          ('/user/Email'), ('/n_chars'), ('/list/0'), ('/list/1'), ('/login/0/password_hash'))
        SELECT doc_id, path, CASE path WHEN '/user/text' THEN text WHEN '/user/source' THEN CASE WHEN doc_id % 3 <> 0 THEN source END WHEN '/user/Email' THEN lang
          WHEN '/n_chars' THEN CAST(n_chars AS VARCHAR) WHEN '/list/0' THEN lang WHEN '/list/1' THEN text ELSE 'x' END AS value FROM d, leaf""",
)
def _json_paths(spark, sf):
    nodes = _bag_nodes(spark, sf, privacy.SCRUB_MAX_DEPTH)
    rows = nodes.select("doc_id", F.inline(jsonpaths.scrub_json_nodes(F.col("nodes"))))
    return rows.filter(~F.col("kind").isin(jsonpaths.OBJECT, jsonpaths.LIST)).select("doc_id", "path", "value")


@query(
    "sensitive_json_paths",
    "SELECT doc_id, unnest(['/user/Email', '/login/0/password_hash']) AS path FROM documents",
)
def _json_sensitive(spark, sf):
    return _bag_nodes(spark, sf, values.MAX_DEPTH).select("doc_id", F.explode(jsonpaths.sensitive_json_paths(F.col("nodes"))).alias("path"))


@query(
    "poisoned_json_paths",
    """SELECT doc_id, CASE doc_id % 8 WHEN 1 THEN 'invalid_json' WHEN 2 THEN 'not_an_object' WHEN 4 THEN 'too_deep' END AS error,
         CASE WHEN doc_id % 8 IN (1, 4, 6) THEN 0 WHEN doc_id % 8 = 3 THEN 5 WHEN doc_id % 8 = 5 THEN 34 WHEN doc_id % 8 = 0 THEN 3 ELSE 2 END AS n_nodes,
         CASE doc_id % 8 WHEN 0 THEN '� x' END AS a,
         CASE doc_id % 8 WHEN 3 THEN 'm[0]:not_finite,n:not_finite' WHEN 5 THEN 'd:depth_exceeded' ELSE '' END AS warnings FROM documents""",
)
def _json_poisoned(spark, sf):
    # Kept apart from the bag, a row whose text cannot be read stays.
    bags = fx.documents(spark, sf).select("doc_id", F.expr(_POISON).alias("j"))
    rows = jsonpaths.with_json_nodes(bags, "j")
    nodes = F.col("nodes")
    found = F.transform(jsonpaths.json_warnings(nodes), lambda w: F.concat_ws(":", w["key"], w["kind"]))
    return rows.select(
        "doc_id",
        jsonpaths.json_error(F.col("j"), nodes).alias("error"),
        F.coalesce(F.size(nodes), F.lit(0)).alias("n_nodes"),
        F.get(F.filter(nodes, lambda x: x["path"] == "/a"), F.lit(0))["value"].alias("a"),
        F.array_join(F.array_sort(found), ",").alias("warnings"),
    )


@query(
    "property_warnings",
    f"""WITH {_DOC_BAG_SQL}
    SELECT doc_id, 'text' AS key, 'truncated_string' AS kind FROM bags WHERE length(text) > 1024
    UNION ALL SELECT doc_id, 'parts[1]', 'truncated_string' FROM bags WHERE length(text) > 1024
    UNION ALL SELECT doc_id, 'score', 'not_finite' FROM bags WHERE NOT isfinite(score)""",
)
def _warnings(spark, sf):
    df = _doc_bag(spark, sf).select(
        "doc_id",
        F.struct(
            F.col("bag.texts").alias("texts"),
            F.array(F.col("bag.tags")[0], F.col("bag.texts")["text"]).alias("parts"),
            F.col("bag.score").alias("score"),
        ).alias("bag"),
    )
    found = values.property_warnings(F.col("bag"), df.schema["bag"].dataType)
    return df.select("doc_id", F.explode(found).alias("w")).select("doc_id", "w.key", "w.kind")


@query("scrub_pii", f"SELECT doc_id, {_scrub_sql('text')} AS text FROM documents")
def _scrub(spark, sf):
    return fx.documents(spark, sf).select("doc_id", privacy.scrub_pii(F.col("text")).alias("text"))


@query(
    "scrub_pii_deep",
    f"SELECT doc_id, {_scrub_sql('text')} AS contact, {_scrub_sql('text')} AS second_tag, lang AS first_tag, n_chars FROM documents",
)
def _scrub_deep(spark, sf):
    df = fx.documents(spark, sf).select(
        "doc_id",
        F.struct(
            F.create_map(F.lit("contact"), "text").alias("user"), F.array("lang", "text").alias("tags"), "n_chars"
        ).alias("bag"),
    )
    clean = df.select("doc_id", privacy.scrub_pii_deep(F.col("bag"), df.schema["bag"].dataType).alias("c"))
    return clean.select(
        "doc_id",
        F.col("c.user")["contact"].alias("contact"),
        F.col("c.tags")[1].alias("second_tag"),
        F.col("c.tags")[0].alias("first_tag"),
        "c.n_chars",
    )


@query("scrub_pii_free_json", f"SELECT doc_id, {_scrub_sql('text')} AS text, n_chars FROM documents")
def _scrub_json(spark, sf):
    scrub = privacy.scrub_pii_json()
    bag = F.to_json(F.struct(F.struct("text").alias("user"), "n_chars"))
    out = fx.documents(spark, sf).select("doc_id", scrub(bag).alias("j"))
    return out.select(
        "doc_id",
        F.get_json_object("j", "$.user.text").alias("text"),
        F.get_json_object("j", "$.n_chars").cast("bigint").alias("n_chars"),
    )


@query(
    "flag_sensitive_keys",
    """SELECT doc_id, array_to_string(list_filter([CASE doc_id % 4 WHEN 0 THEN 'Email' WHEN 1 THEN 'email_opt_in' WHEN 2 THEN 'TOKEN'
         ELSE 'tokens_remaining' END, lang || '_passwordHash', CASE doc_id % 3 WHEN 0 THEN 'creditCard' WHEN 1 THEN 'credit_card_no'
         ELSE 'credit-card' END, source], lambda x: regexp_matches(x, '(?i)^(email|password|token|secret|card|phone)$|password|credit_?card')), ',') AS hits
       FROM documents""",
)
def _sensitive(spark, sf):
    doc = F.col("doc_id")
    keys = F.array(
        F.when(doc % 4 == 0, "Email").when(doc % 4 == 1, "email_opt_in").when(doc % 4 == 2, "TOKEN").otherwise("tokens_remaining"),
        F.concat("lang", F.lit("_passwordHash")),
        F.when(doc % 3 == 0, "creditCard").when(doc % 3 == 1, "credit_card_no").otherwise("credit-card"),
        F.col("source"),
    )
    return fx.documents(spark, sf).select("doc_id", F.array_join(privacy.flag_sensitive_keys(keys), ",").alias("hits"))


_GATE_SQL = """
    claims AS (SELECT event_id, CASE WHEN k % 11 = 0 THEN 'sk_' || k WHEN k % 2 = 0 THEN 'pub_live_' || k ELSE 'pub_test_' || k END AS public_key,
               CASE WHEN k % 5 < 3 THEN 'production' ELSE 'sandbox' END AS environment,
               CASE WHEN k % 13 = 0 THEN '' ELSE 'app_' || (k % 30) END AS app_id,
               CASE WHEN k % 7 = 0 THEN '' ELSE name END AS name,
               CASE WHEN k % 4 = 0 THEN '' WHEN k % 4 = 1 THEN 'com.other' ELSE 'com.app' || (k % 30) END AS package_name FROM v_events)"""


def _claims(spark, sf):
    return fx.events(spark, sf).selectExpr(
        "event_id",
        "case when k % 11 = 0 then concat('sk_', k) when k % 2 = 0 then concat('pub_live_', k) else concat('pub_test_', k) end as public_key",
        "case when k % 5 < 3 then 'production' else 'sandbox' end as environment",
        "case when k % 13 = 0 then '' else concat('app_', k % 30) end as app_id",
        "case when k % 7 = 0 then '' else name end as name",
        "case when k % 4 = 0 then '' when k % 4 = 1 then 'com.other' else concat('com.app', k % 30) end as package_name",
    )


_REJECT_SQL = """CASE WHEN NOT starts_with(public_key, 'pub_') THEN 'invalid_secret_key'
    WHEN environment <> CASE WHEN starts_with(public_key, 'pub_live_') THEN 'production' ELSE 'sandbox' END THEN 'env_mismatch'
    WHEN app_id = '' THEN 'missing_app_id' WHEN name = '' THEN 'missing_event_name' END"""


@query("ingest_gate", sql(f"WITH {_GATE_SQL} SELECT event_id, {_REJECT_SQL} AS reject_code FROM claims", "v_events"))
def _ingest_gate(spark, sf):
    code = gates.ingest_gate(F.col("public_key"), F.col("environment"), F.col("app_id"), F.col("name"))
    return _claims(spark, sf).select("event_id", code.alias("reject_code"))


@query(
    "package_lock_gate",
    sql(
        f"""WITH {_GATE_SQL} SELECT event_id, CASE WHEN package_name <> '' AND package_name = registered THEN NULL
        ELSE 'package_name_not_allowed' END AS reject_code FROM claims LEFT JOIN
        (SELECT 'app_' || n_nationkey AS app_id, CASE WHEN n_nationkey % 6 = 0 THEN '' ELSE 'com.app' || n_nationkey END AS registered
         FROM nation) USING (app_id)""",
        "v_events",
    ),
)
def _package_lock(spark, sf):
    apps = fx.table(spark, sf, "nation").selectExpr(
        "concat('app_', n_nationkey) as app_id",
        "case when n_nationkey % 6 = 0 then '' else concat('com.app', n_nationkey) end as registered_package",
    )
    return gates.package_lock_gate(_claims(spark, sf), apps).select("event_id", "reject_code")


@query(
    "wire_traits",
    """SELECT doc_id, CASE WHEN doc_id % 3 = 0 AND doc_id % 2 = 0 THEN NULL
         WHEN doc_id % 3 = 0 THEN 'n=' || CAST(n_chars AS VARCHAR) WHEN doc_id % 2 = 0 THEN 's=' || source
         ELSE 'n=' || CAST(n_chars AS VARCHAR) || ',s=' || source END AS traits FROM documents""",
)
def _wire_traits(spark, sf):
    doc = F.col("doc_id")
    df = fx.documents(spark, sf).select(
        "doc_id",
        F.create_map(
            F.lit("n"), F.when(doc % 2 != 0, F.col("n_chars").cast("string")),
            F.lit("s"), F.when(doc % 3 != 0, F.col("source")),
        ).alias("bag"),
    )
    traits = values.wire_traits(F.col("bag"), df.schema["bag"].dataType)
    pairs = F.transform(F.array_sort(F.map_entries("t")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return df.select("doc_id", traits.alias("t")).select("doc_id", F.array_join(pairs, ",").alias("traits"))


_SCREEN_SQL = """CASE k % 8 WHEN 0 THEN 'androidx.activity.A' WHEN 1 THEN 'android.app.B' WHEN 2 THEN 'com.android.C'
    WHEN 3 THEN 'com.x.ComposeActivity$Default' WHEN 4 THEN 'com.x.ComposeActivity' WHEN 5 THEN 'com.x.$Default'
    ELSE 'com.x.Home' || k END"""


def _screens(df):
    screen = "concat('com.x.Home', k)"
    names = ["androidx.activity.A", "android.app.B", "com.android.C", "com.x.ComposeActivity$Default", "com.x.ComposeActivity", "com.x.$Default"]
    cases = " ".join(f"when {i} then '{n}'" for i, n in enumerate(names))
    return df.withColumn("screen", F.expr(f"case k % 8 {cases} else {screen} end"))


@query(
    "drop_framework_screens",
    sql(
        f"""WITH s AS (SELECT event_id, {_SCREEN_SQL} AS screen FROM v_events WHERE name = 'page.viewed')
        SELECT * FROM s WHERE NOT (starts_with(screen, 'androidx.') OR starts_with(screen, 'android.') OR starts_with(screen, 'com.android.')
        OR (contains(screen, 'ComposeActivity') AND contains(screen, '$Default')))""",
        "v_events",
    ),
)
def _framework_screens(spark, sf):
    views = _screens(fx.events(spark, sf).filter("name = 'page.viewed'"))
    return gates.drop_framework_screens(views).select("event_id", "screen")


# Half of the labels end in a word of a list, near misses among them; each holds its whole text, whose own words decide too.
_LABELS = [*privacy.PII_LABEL_WORDS, "pine", "spinner", "shopping cart", "country"]
_LABEL_SQL = f"""labels AS (SELECT doc_id, coalesce(text, '') || CASE WHEN doc_id % 4 = 0 THEN ' ' || upper(w) WHEN doc_id % 4 = 1 THEN ' ' || w ELSE '' END AS label
    FROM (SELECT doc_id, text, {_LABELS!r}[CAST(doc_id % {len(_LABELS)} AS INT) + 1] AS w FROM documents))"""


@query(
    "drop_pii_labels",
    f"WITH {_LABEL_SQL} SELECT doc_id, label FROM labels WHERE NOT regexp_matches(lower(label), '{'|'.join(privacy.PII_LABEL_WORDS)}')",
)
def _pii_labels(spark, sf):
    word = F.get(F.array(*[F.lit(w) for w in _LABELS]), (F.col("doc_id") % len(_LABELS)).cast("int"))
    kind = F.col("doc_id") % 4
    tail = F.when(kind == 0, F.concat(F.lit(" "), F.upper(word))).when(kind == 1, F.concat(F.lit(" "), word)).otherwise("")
    label = F.concat(F.coalesce("text", F.lit("")), tail)
    return gates.drop_pii_labels(fx.documents(spark, sf).select("doc_id", label.alias("label")), "label")


@query(
    "drop_opted_out",
    "SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 5 = 0",
)
def _opted_out(spark, sf):
    # The marker as it stands opts out; its words apart or in capitals do not.
    mark = F.when(F.col("doc_id") % 5 == 0, F.upper(F.lit(gates.OPT_OUT_MARKER))).otherwise(gates.OPT_OUT_MARKER)
    described = F.concat("source", F.lit(" "), F.when(F.col("doc_id") % 3 == 0, mark).otherwise("no track"))
    return gates.drop_opted_out(fx.documents(spark, sf).select("doc_id", described.alias("description")), "description").select("doc_id")


@query(
    "drop_self_errors",
    sql("SELECT event_id FROM v_errors WHERE k % 9 <> 0", "v_errors"),
)
def _self_errors(spark, sf):
    return gates.drop_self_errors(fx.errors(spark, sf), "api.ingest.example").select("event_id")


@query(
    "before_send",
    sql("SELECT event_id, 'E' || (k % 4) AS type FROM v_errors WHERE fatal", "v_errors"),
)
def _before_send(spark, sf):
    def hook(rows):
        return rows.filter("fatal").withColumn("type", F.replace("type", F.lit("com.app."), F.lit("")))

    return gates.before_send(fx.errors(spark, sf), hook).select("event_id", "type")


@query(
    "lock_schema",
    sql(
        """SELECT event_id, array_to_string(list_sort(list_filter(['contract_id', CASE WHEN k % 2 = 0 THEN 'run_id' END, CASE WHEN k % 3 = 0 THEN 'test_file' END],
             lambda x: x IS NOT NULL)), ',') AS kept,
           4 + (k % 2)::INT AS n_missing, CASE WHEN k % 5 = 0 THEN 'anonymousId' ELSE '' END AS refused FROM v_errors""",
        "v_errors",
    ),
)
def _lock_schema(spark, sf):
    e = fx.errors(spark, sf)
    pairs = F.create_map(
        F.lit("contract_id"), F.concat(F.lit("c_"), "k"),
        F.lit("run_id"), F.when(F.col("k") % 2 == 0, F.lit("r")),
        F.lit("test_file"), F.when(F.col("k") % 3 == 0, F.lit("f")),
        F.lit("anonymousId"), F.when(F.col("k") % 5 == 0, F.col("dev")),
    )
    given = e.select("event_id", F.map_filter(pairs, lambda _, v: v.isNotNull()).alias("p"))
    return given.select("event_id", gates.lock_schema(F.col("p")).alias("l")).select(
        "event_id",
        F.array_join(F.array_sort(F.map_keys("l.payload")), ",").alias("kept"),
        F.size("l.missing").alias("n_missing"),
        F.array_join("l.refused", ",").alias("refused"),
    )


@query(
    "host_of",
    r"""SELECT page_id, host, coalesce(host = 'www.cheap-pills.example.com', false) AS is_self FROM
        (SELECT page_id, nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host FROM pages)""",
)
def _host_of(spark, sf):
    url = F.col("url")
    return fx.links(spark, sf).select(
        "page_id", host_of(url).alias("host"), is_self_request(url, "WWW.Cheap-Pills.example.com").alias("is_self")
    )


_LINK_SQL = r"""
    links AS (SELECT page_id, url || CASE WHEN contains(url, '#') THEN '' WHEN contains(url, '?') THEN '&' ELSE '?' END ||
              CASE WHEN contains(url, '#') THEN '' ELSE 'GCLID=g%20' || page_id || '&utm_term=' || CASE WHEN page_id % 2 = 0 THEN '' ELSE 't+' || page_id END END AS url FROM pages),
    parts AS (SELECT page_id, url, nullif(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1), '') AS host,
              nullif(url_decode(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)), '') AS path,
              list_transform(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda p:
                {'k': lower(split_part(p, '=', 1)), 'v': url_decode(replace(split_part(p, '=', 2), '+', ' '))}) AS kv FROM links)"""


def _pick(name: str) -> str:
    return f"nullif(list_filter(kv, lambda x: x.k = '{name}')[1].v, '') AS {name}"


_PICKS = ", ".join(_pick(k) for k in ATTRIBUTION_KEYS)
_ATTRIBUTED = (
    "concat(url, case when contains(url, '#') then '' when contains(url, '?') then '&' else '?' end, "
        "case when contains(url, '#') then '' else concat('GCLID=g%20', page_id, '&utm_term=', "
        "case when page_id % 2 = 0 then '' else concat('t+', page_id) end) end)"
)


@query(
    "drop_pii_labels_of_texts",
    f"SELECT doc_id, md5(text) AS label FROM documents WHERE NOT regexp_matches(lower(coalesce(text, '')), '{'|'.join(privacy.PII_LABEL_WORDS)}')",
)
def _pii_texts(spark, sf):
    """The label rule over whole texts, whatever they hold."""
    return gates.drop_pii_labels(fx.documents(spark, sf).select("doc_id", "text"), "text").select("doc_id", F.md5("text").alias("label"))


@query(
    "run_hook",
    sql(
        """SELECT event_id, CASE WHEN k % 7 = 3 OR k % 11 = 4 THEN type ELSE type || '!' END AS type, user_id,
             CASE WHEN k % 7 = 3 THEN 'hook_failed: ZeroDivisionError' WHEN k % 11 = 4 THEN 'hook_failed: ArrowInvalid' END AS error
           FROM v_errors WHERE k % 5 <> 0""",
        "v_errors",
    ),
)
def _run_hook(spark, sf):
    """A hook that drops, rewrites, raises, and returns what is no row; only the row concerned is refused."""

    def hook(row):
        if row["k"] % 5 == 0:
            return None
        if row["k"] % 7 == 3:
            return {"k": 1 // 0}
        return {**row, "type": row["type"] + "!", "user_id": "nobody" if row["k"] % 11 == 4 else row["user_id"]}

    rows = fx.errors(spark, sf).select("event_id", "type", "user_id", "k")
    return gates.run_hook(rows, hook, "error").drop("k")


@query(
    "extract_attribution",
    f"WITH {_LINK_SQL} SELECT page_id, url, host, path, {_PICKS} FROM parts",
)
def _attribution(spark, sf):
    url = F.expr(_ATTRIBUTED)
    found = fx.links(spark, sf).select("page_id", url.alias("url")).select("page_id", extract_attribution(F.col("url")).alias("a"))
    return found.select("page_id", "a.url", "a.host", "a.path", *[f"a.{k}" for k in ATTRIBUTION_KEYS])


# Links as they come: spaces, bars, broken escapes, names in both cases, repeats, no authority, no hierarchy.
_ODD_URL = (
    "case page_id % 9 when 0 then concat('https://my_app', page_id, '.X.com/a b?utm_source=a|b&utm_term=100%&UTM_medium=m%20', page_id) "
    "when 1 then concat('https://u:p@h.com:8080/p%2Fq+r?utm_source=&UTM_SOURCE=s', page_id, '&utm_source=late') "
    "when 2 then concat('app://open?gclid=g', page_id, '&gclid=h&GCLID=&fbclid=%zz1') when 3 then 'mailto:a@b.io?utm_source=x' "
    "when 4 then concat('/local/path', page_id, '?msclkid=k&ttclid=+t+&li_fat_id=%E9%C3%A9#f?utm_source=no') "
    "when 5 then concat('https://h.com?utm_campaign=c', page_id, '=d&twclid&utm_content=x=') "
    "when 6 then '' when 7 then null else url end"
)
_ODD_SQL = r"""
    odd AS (SELECT page_id, CASE WHEN page_id % 9 = 8 THEN regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) END AS h8,
        CASE WHEN page_id % 9 = 8 THEN nullif(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1), '') END AS p8, CASE page_id % 9
        WHEN 0 THEN {'h': 'my_app' || page_id || '.X.com', 'p': '/a b', 'utm_source': 'a|b', 'utm_term': '100%', 'utm_medium': 'm ' || page_id}
        WHEN 1 THEN {'h': 'h.com', 'p': '/p/q+r', 'utm_source': 's' || page_id, 'utm_term': NULL, 'utm_medium': NULL}
        WHEN 2 THEN {'h': 'open', 'p': NULL, 'utm_source': NULL, 'utm_term': NULL, 'utm_medium': NULL}
        WHEN 4 THEN {'h': NULL, 'p': '/local/path' || page_id, 'utm_source': NULL, 'utm_term': NULL, 'utm_medium': NULL}
        WHEN 5 THEN {'h': 'h.com', 'p': NULL, 'utm_source': NULL, 'utm_term': NULL, 'utm_medium': NULL} END AS o FROM pages)
    SELECT page_id, coalesce(o.h, h8) AS host, coalesce(o.p, p8) AS path, o.utm_source, o.utm_medium, o.utm_term,
      CASE WHEN page_id % 9 = 5 THEN 'c' || page_id || '=d' END AS utm_campaign, CASE WHEN page_id % 9 = 5 THEN 'x=' END AS utm_content,
      CASE WHEN page_id % 9 = 2 THEN 'g' || page_id END AS gclid, CASE WHEN page_id % 9 = 2 THEN '%zz1' END AS fbclid,
      CASE WHEN page_id % 9 = 4 THEN 'k' END AS msclkid, CASE WHEN page_id % 9 = 4 THEN ' t ' END AS ttclid,
      CASE WHEN page_id % 9 = 4 THEN '�é' END AS li_fat_id, NULL AS twclid FROM odd"""


@query("extract_attribution_of_odd_links", f"WITH {_ODD_SQL}")
def _odd_links(spark, sf):
    """Every page, every key: links that name no host, no path or no campaign have nulls there."""
    links = fx.links(spark, sf).select("page_id", F.expr(_ODD_URL).alias("url"))
    found = links.select("page_id", extract_attribution(F.col("url")).alias("a"))
    return found.select("page_id", "a.host", "a.path", *[f"a.{k}" for k in ATTRIBUTION_KEYS])


@query(
    "deep_link_properties",
    f"""WITH {_LINK_SQL} SELECT page_id, 'push' AS source, CASE WHEN page_id % 3 <> 0 THEN 'view' END AS action, 'com.app' AS package, url, host, path, {_PICKS} FROM parts""",
)
def _deep_links(spark, sf):
    action = F.when(F.col("page_id") % 3 == 0, "").otherwise("view")
    bag = deep_link_properties(F.expr(_ATTRIBUTED), F.lit("push"), action, F.lit("com.app"))
    found = fx.links(spark, sf).select("page_id", bag.alias("p"))
    names = ["source", "action", "package", "url", "host", "path", *ATTRIBUTION_KEYS]
    return found.select("page_id", *[F.try_element_at("p", F.lit(n)).alias(n) for n in names])


@query(
    "project_push",
    sql(
        """SELECT event_id, array_to_string(list_sort(list_filter([CASE WHEN k % 2 = 0 THEN 'actionId=a' || k END, 'campaignId=c' || k,
           CASE WHEN k % 3 <> 0 THEN 'type=t' END], lambda x: x IS NOT NULL)), ',') AS props FROM v_events""",
        "v_events",
    ),
)
def _push(spark, sf):
    data = F.expr("map('campaignId', concat('c', k), 'type', case when k % 3 = 0 then '' else 't' end, 'title', 'hello', 'body', dev)")
    action = F.expr("case when k % 2 = 0 then concat('a', k) end")
    pairs = F.transform(F.map_entries("p"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    out = fx.events(spark, sf).select("event_id", project_push(data, action).alias("p"))
    return out.select("event_id", F.array_join(F.array_sort(pairs), ",").alias("props"))


@query(
    "idempotency_key",
    sql(
        """WITH d AS (SELECT event_id, sha256('acme:purchases/sync:' || rail || ':' || CASE rail WHEN 'apple' THEN jws WHEN 'google' THEN nullif(token, '') END) AS h
             FROM (SELECT event_id, CASE k % 3 WHEN 0 THEN 'apple' WHEN 1 THEN 'google' ELSE 'stripe' END AS rail, 'jws.' || event_id AS jws,
                   CASE WHEN k % 7 = 0 THEN '' ELSE 'tok_' || event_id END AS token FROM v_events))
           SELECT event_id, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] AS idem_key FROM d""",
        "v_events",
    ),
)
def _idempotency(spark, sf):
    e = fx.events(spark, sf).selectExpr(
        "event_id",
        "case k % 3 when 0 then 'apple' when 1 then 'google' else 'stripe' end as rail",
        "concat('jws.', event_id) as jws",
        "case when k % 7 = 0 then '' else concat('tok_', event_id) end as token",
    )
    key = idempotency_key(F.col("rail"), F.col("jws"), F.col("token"), "acme")
    return e.select("event_id", key.alias("idem_key"))


@query(
    "user_slot",
    sql(
        "SELECT event_id, CASE WHEN k % 5 IN (0, 1) THEN '_anon' ELSE sha256('user_' || user_id) END AS slot FROM v_events",
        "v_events",
    ),
)
def _user_slot(spark, sf):
    user = F.expr("case when k % 5 = 0 then null when k % 5 = 1 then '' else concat('user_', user_id) end")
    return fx.events(spark, sf).select("event_id", user_slot(user).alias("slot"))


@query("cap_text", "SELECT doc_id, substring(text, 1, 128) AS text FROM documents")
def _cap_text(spark, sf):
    return fx.documents(spark, sf).select("doc_id", values.cap_text(F.col("text")).alias("text"))


@query(
    "device_payload",
    sql(
        """SELECT event_id, 'app_version=' || CASE WHEN k % 2 = 0 THEN '1.' || k END AS version_pair,
           CASE WHEN k % 2 = 0 THEN 3 ELSE 2 END AS n_fields FROM v_events""",
        "v_events",
    ),
)
def _device_payload(spark, sf):
    payload = values.device_payload(
        platform=F.lit("android"), sdk_int=F.lit(34), app_version=F.expr("case when k % 2 = 0 then concat('1.', k) end")
    )
    out = fx.events(spark, sf).select("event_id", payload.alias("p"))
    version = F.concat(F.lit("app_version="), F.try_element_at("p", F.lit("app_version")))
    return out.select("event_id", version.alias("version_pair"), F.size("p").alias("n_fields"))


@query(
    "resolve_label",
    sql(
        "SELECT event_id, CASE WHEN k % 2 = 0 THEN 'l' || k WHEN k % 3 = 0 THEN 'title' WHEN k % 5 = 0 THEN dev END AS label FROM v_events",
        "v_events",
    ),
)
def _label(spark, sf):
    def c(e):
        return F.expr(e)

    label = values.resolve_label(
        c("case when k % 2 = 0 then concat('l', k) else '' end"),
        c("cast(null as string)"),
        c("case when k % 3 = 0 then 'title' end"),
        c("''"),
        c("cast(null as string)"),
        c("case when k % 5 = 0 then dev end"),
    )
    return fx.events(spark, sf).select("event_id", label.alias("label"))


@query(
    "page_key",
    """SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN '/p/' || page_id ELSE 'Screen' END AS page FROM pages""",
)
def _page_key(spark, sf):
    key = values.page_key(
        F.expr("case when page_id % 3 = 0 then url end"),
        F.expr("case when page_id % 3 <> 2 then concat('/p/', page_id) end"),
        F.lit("Screen"),
    )
    return fx.links(spark, sf).select("page_id", key.alias("page"))
