"""Personal data: fixed patterns, and identifiers found by bootstrapped contexts.

The matches of four fixed patterns are the seeds. A lexical pattern is the one
or two words to the left of a token that holds a digit or an at sign. In each
round the words before known entities become patterns, a pattern's confidence is
the share of all its occurrences in the corpus that a known entity follows, and
unseen tokens that confident patterns vouch for are found where these stand
before them. Those that mostly stand there become known entities, are found
everywhere and may make new patterns, until a round finds nothing fresh. All of
it is DataFrame expressions; the texts are read once per round for the patterns
that are new in it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
#: What the bootstrapping finds.
FOUND = "identifier"
#: The four patterns, anchored so that no run of characters is read more than once and nothing recurses.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:|[1-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
#: A token with a digit or an at sign.
_CANDIDATE = r"(?<![^ \t-\r])(?=[^ \t-\r0-9@]*+[0-9@])[^ \t-\r]++"
# Begun only where a word begins, so that long words are read once.
_WORD = r"(?<![^ \t-\r])([^ \t-\r]++)"
_TWO_WORDS = r"(?<![^ \t-\r])([^ \t-\r]++[ \t-\r]++[^ \t-\r]++)"
_EDGES = ".,;:!?()[]{}<>\"'"
#: A pattern needs so many different known entities, and that they follow in this share of its occurrences.
SUPPORT = 3
CONFIDENCE = 0.7
#: A found token is known everywhere if this share of its places follow confident patterns; others are found at these alone.
SHARE = 0.5
#: Up to so many patterns are broadcast to be counted in the texts; more are joined by a shuffle.
BROADCAST_PATTERNS = 20_000


def starts_of(matches: Column, parts: Column) -> Column:
    """Offsets of the matches, given the texts between them.

    Prefix sums by blocks of about the square root of their number, so that many matches in one text stay cheap.
    """
    n = F.size(matches)
    gap = F.transform(parts, F.char_length)
    step = F.zip_with(F.slice(gap, 1, n), F.transform(matches, F.char_length), lambda a, b: a + b)

    def total(values: Column, start: Column, length: Column) -> Column:
        return F.aggregate(F.slice(values, start, length), F.lit(0), lambda a, b: a + b)

    # Arrays of one element bind what is used again and again.
    def offsets(x: Column) -> Column:
        block, gaps, steps = x["block"], x["gap"], x["step"]
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int")),
                lambda b: F.flatten(
                    F.transform(
                        F.array(total(steps, F.lit(1), b * block)),
                        lambda base: F.transform(
                            F.sequence(F.lit(1), F.least(block, n - b * block)),
                            lambda k: base + total(steps, b * block + 1, k - 1) + F.get(gaps, b * block + k - 1),
                        ),
                    )
                ),
            )
        )

    bound = F.array(F.struct(F.ceil(F.sqrt(n)).cast("int").alias("block"), gap.alias("gap"), step.alias("step")))
    return F.when(n == 0, F.array().cast("array<int>")).otherwise(F.flatten(F.transform(bound, offsets)))


def matches_of(df: DataFrame, text: str, pattern: str, name: str, only: Column) -> DataFrame:
    """Add ``name``: array of (start, end, match) of the pattern's leftmost matches, end exclusive; empty unless ``only``."""
    none = F.array().cast("array<string>")
    df = df.withColumn("_m", F.when(only, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(none))
    df = df.withColumn("_s", starts_of(F.col("_m"), F.col("_p")))
    spans = F.zip_with("_s", "_m", lambda s, m: F.struct(s.alias("start"), (s + F.char_length(m)).alias("end"), m.alias("match")))
    return df.withColumn(name, spans)


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        v = F.substring(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(v > 9, v - 9).otherwise(v)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def kept_spans(kind: str, no: int) -> Column:
    """The valid matches of one kind as (start, kind number, end)."""
    good = F.filter(f"_{kind}", lambda x: valid(kind, x["match"]))
    return F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(no).alias("kind"), x["end"].alias("end")))


def of_kind(spans: str, no: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == no)


def counted(no: int) -> Column:
    return F.size(of_kind("base", no)).cast("long")


def base_spans(df: DataFrame, text: str, name: str = "base") -> DataFrame:
    """Add ``name``: array of (start, kind number, end) of the four kinds, in that order."""
    digit = F.col(text).rlike("[0-9]")
    only = {"email": F.contains(F.col(text), F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(F.col(text), F.lit("+"))}
    columns = df.columns
    for kind in KINDS:
        df = matches_of(df, text, PATTERNS[kind], f"_{kind}", only[kind])
    found = [kept_spans(kind, no) for no, kind in enumerate(KINDS)]
    return df.withColumn(name, F.array_sort(F.concat(*found))).select(*columns, name)


def below(sorted_starts: Column, limit: Column) -> Column:
    """How many of the sorted numbers are below the limit, by halving steps."""
    powers = F.filter(F.array(*[F.lit(1 << b) for b in range(30, -1, -1)]), lambda p: p <= F.size(sorted_starts))
    return F.aggregate(powers, F.lit(0), lambda n, p: F.when(F.coalesce(F.get(sorted_starts, n + p - 1) < limit, F.lit(False)), n + p).otherwise(n))


def candidates(df: DataFrame, text: str, base: str, name: str = "tokens") -> DataFrame:
    """Add ``name``: array of (start, end, token, one, two, known): tokens like identifiers with the words before them.

    known is true where a base span begins; tokens further inside a base span are left out. Spans of one kind do not
    overlap, so of each kind the span before the token and the one after are looked up, whatever their number.
    """
    columns = df.columns
    for no, kind in enumerate(KINDS):
        spans = of_kind(base, no)
        df = df.withColumn(f"_at_{kind}", F.transform(spans, lambda s: s["start"])).withColumn(f"_to_{kind}", F.transform(spans, lambda s: s["end"]))
    df = matches_of(df, text, _CANDIDATE, "_c", F.col(text).rlike("[0-9@]"))
    # The two words before a token lie in what is between the last two tokens and it, and in these.
    def left(i: Column) -> Column:
        def one(of: str, at: Column) -> Column:
            return F.coalesce(F.get(of, at), F.lit(""))

        return F.concat(F.when(i > 2, one("_m", i - 3)).otherwise(F.lit("")), F.when(i > 1, F.concat(one("_p", i - 2), one("_m", i - 2))).otherwise(F.lit("")), F.get("_p", i - 1))

    before = F.transform(F.sequence(F.lit(1), F.size("_m")), left)
    df = df.withColumn("_b", F.when(F.size("_m") > 0, before).otherwise(F.array().cast("array<string>")))

    def begins(x: Column) -> Column:
        """Whether a base span begins in the token."""
        return F.exists(F.array(*[F.get(f"_at_{kind}", below(F.col(f"_at_{kind}"), x["start"])) for kind in KINDS]), lambda at: F.coalesce(at < x["end"], F.lit(False)))

    def inside(x: Column) -> Column:
        """Whether a base span that began before the token covers its first character."""
        return F.exists(F.array(*[F.get(f"_to_{kind}", below(F.col(f"_at_{kind}"), x["start"]) - 1) for kind in KINDS]), lambda to: F.coalesce(to > x["start"], F.lit(False)))

    def token(x: Column, b: Column) -> Column:
        lead = F.char_length(x["match"]) - F.char_length(F.ltrim(x["match"], F.lit(_EDGES)))
        core = F.trim(x["match"], F.lit(_EDGES))
        start = x["start"] + lead
        return F.struct(
            start.alias("start"),
            (start + F.char_length(core)).alias("end"),
            core.alias("token"),
            F.lower(F.regexp_extract(b, rf"{_WORD}[ \t-\r]++$", 1)).alias("one"),
            F.lower(F.regexp_extract(b, rf"{_TWO_WORDS}[ \t-\r]++$", 1)).alias("two"),
            begins(x).alias("known"),
            inside(x).alias("inside"),
        )

    tokens = F.filter(F.zip_with("_c", "_b", token), lambda x: ~x["inside"] & (x["known"] | x["token"].rlike("[0-9@]")))
    return df.withColumn(name, tokens).select(*columns, name)


def word_pairs(text: Column) -> Column:
    """The lower-cased words of a text, and each two neighbours with one space between."""
    words = F.split(F.lower(text), r"[ \t-\r]+")
    return F.flatten(F.transform(F.array(words), lambda w: F.concat(w, F.zip_with(F.slice(w, 1, F.size(w) - 1), F.slice(w, 2, F.size(w)), lambda a, b: F.concat_ws(" ", a, b)))))


def occurrences_of(docs: DataFrame, text: str, patterns: DataFrame, number: int) -> DataFrame:
    """How often each of the patterns, ``number`` in all, stands in the texts."""
    places = docs.select(F.explode(word_pairs(F.col(text))).alias("pattern"))
    return places.join(F.broadcast(patterns) if number <= BROADCAST_PATTERNS else patterns, "pattern", "left_semi").groupBy("pattern").count()


def bootstrap(found: DataFrame, docs: DataFrame, text: str) -> DataFrame | None:
    """Keys and spans of tokens that confident patterns vouch for; None when there are none.

    ``found`` has _id, _hash and tokens; ``docs`` the texts, for the patterns' occurrences. Each round knows at least
    one token more than the last, so the rounds end.
    """
    slots = found.select("_id", "_hash", F.explode("tokens").alias("x")).select("_id", "_hash", "x.*")
    edge = slots.select("_id", "_hash", "token", "start", "end", "known", F.explode(F.array("one", F.regexp_replace("two", r"[ \t-\r]+", " "))).alias("pattern")).filter("pattern <> ''")
    edge = written(edge)
    places = written(slots.filter("not known").groupBy("token").agg(F.count(F.lit(1)).alias("places")))
    known = edge.filter("known").select("token").distinct()
    counted_yet: DataFrame | None = None
    good: DataFrame | None = None
    new: DataFrame | None = None
    while True:
        # Copies of a text repeat its slots: entities count once for each pattern.
        support = edge.join(known, "token", "left_semi").groupBy("pattern").agg(F.countDistinct("token").alias("entities"), F.count(F.lit(1)).alias("hits"))
        pool = written(support.filter(F.col("entities") >= SUPPORT))
        wanted = pool.select("pattern")
        if counted_yet is not None:
            wanted = wanted.join(counted_yet.select("pattern"), "pattern", "left_anti")
        size = wanted.count()
        if size:
            fresh_counts = written(occurrences_of(docs, text, wanted, size))
            counted_yet = fresh_counts if counted_yet is None else counted_yet.unionByName(fresh_counts)
        if counted_yet is None:
            return None
        rated = pool.join(counted_yet, "pattern").withColumn("confidence", F.least(F.col("hits") / F.col("count"), F.lit(1.0))).filter(F.col("confidence") >= CONFIDENCE)
        good = written(rated.select("pattern", "confidence"))
        # An instance's score: that not all of its patterns are wrong. Its share: of its places, those after such patterns.
        vouched = edge.filter("not known").join(known, "token", "left_anti").join(good, "pattern")
        at = vouched.groupBy("token", "_id", "_hash", "start").agg(F.lit(1).alias("one")).groupBy("token").agg(F.count("one").alias("after"))
        scored = vouched.select("token", "pattern", "confidence").distinct().groupBy("token").agg((1 - F.exp(F.sum(F.log(1.0001 - F.col("confidence"))))).alias("score"))
        sure = scored.filter(F.col("score") >= CONFIDENCE).join(at, "token").join(places, "token").filter(F.col("after") >= SHARE * F.col("places"))
        fresh = written(sure.select("token"))
        if fresh.isEmpty():
            break
        new = fresh if new is None else new.unionByName(fresh)
        known = known.unionByName(fresh)
    here = edge.filter("not known").join(good, "pattern", "left_semi").select("_id", "_hash", "start", "end")
    if new is not None:
        here = here.unionByName(slots.filter("not known").join(new, "token", "left_semi").select("_id", "_hash", "start", "end"))
    return here.distinct().select("_id", "_hash", F.struct("start", F.lit(len(KINDS)).alias("kind"), "end").alias("span"))


def find_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame | None]:
    """The base spans of each row (written), and the found spans by id and hash of the text, if any."""
    texts = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    found = written(candidates(base_spans(texts, "_text"), "_text", "base").drop("_text"))
    extra = bootstrap(found.filter(F.size("tokens") > 0), texts, "_text")
    if extra is not None:
        extra = extra.groupBy(F.col("_id").alias("_eid"), F.col("_hash").alias("_ehash")).agg(F.collect_set("span").alias("extra"))
    return found.drop("tokens"), extra


def with_extra(df: DataFrame, extra: DataFrame | None) -> DataFrame:
    """Add spans: the base spans and the found ones, in order."""
    if extra is None:
        return df.withColumn("spans", F.col("base"))
    joined = df.join(extra, F.col("_id").eqNullSafe(F.col("_eid")) & (F.col("_hash") == F.col("_ehash")), "left")
    return joined.withColumn("spans", F.array_sort(F.concat("base", F.coalesce("extra", F.array().cast(df.schema["base"].dataType))))).drop("extra", "_eid", "_ehash")


def joined_spans(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, FOUND)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Spans are kind:start:end in code points, by start, then kind; the base spans
    are counted and hashed, spans has the found identifiers too. Null texts
    count as empty and have none. Repeated rows are answered each for itself;
    other columns are ignored; no rows give no rows.
    """
    found, extra = find_entities(docs, id_col, text_col)
    rows = with_extra(found, extra)
    counts = [counted(no).alias(f"n_{kind}") for no, kind in enumerate(KINDS)]
    return rows.select(F.col("_id").alias(id_col), *counts, F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"), joined_spans(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets; overlapping spans become one, named by the first."""
    # The row goes along as one value, so that its names cannot clash.
    texts = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{id_col}`").alias("_id"), text_or_empty(text_col).alias("_text"))
    found, extra = find_entities(docs, id_col, text_col)
    rows = with_extra(base_spans(texts.withColumn("_hash", F.xxhash64("_text")), "_text"), extra)
    names = F.array(*[F.lit(f"<{k}>") for k in (*KINDS, FOUND)])
    # One pass in blocks of about the square root of the spans: each cuts its own stretch of the text, so that neither
    # the text nor what has been written is gone through again at each span.
    piece = "struct<out: array<string>, at: int>"
    nothing = F.array().cast("array<string>")

    def add(stretch: Column) -> Callable[[Column, Column], Column]:
        def one(state: Column, s: Column) -> Column:
            gap = F.substring(stretch["text"], state["at"] - stretch["at"] + 1, s["start"] - state["at"])
            return F.when(s["start"] < state["at"], F.struct(state["out"].alias("out"), F.greatest(state["at"], s["end"]).alias("at"))).otherwise(
                F.struct(F.concat(state["out"], F.array(gap, F.get(names, s["kind"]))).alias("out"), s["end"].alias("at"))
            ).cast(piece)

        return one

    def block(state: Column, spans: Column) -> Column:
        last = F.get(spans, F.size(spans) - 1)["start"]
        cut = F.struct(state["at"].alias("at"), F.substring(F.col("_text"), state["at"] + 1, F.greatest(last - state["at"], F.lit(0))).alias("text"))
        # An array of one element binds what is used again and again.
        made = F.get(F.transform(F.array(cut), lambda c: F.aggregate(spans, F.struct(nothing.alias("out"), c["at"].alias("at")).cast(piece), add(c))), 0)
        return F.get(F.transform(F.array(made), lambda m: F.struct(F.concat(state["out"], F.array(F.array_join(m["out"], ""))).alias("out"), m["at"].alias("at")).cast(piece)), 0)

    size = F.ceil(F.sqrt(F.size("spans"))).cast("int")
    blocks = F.when(F.size("spans") > 0, F.transform(F.sequence(F.lit(1), F.size("spans"), size), lambda i: F.slice("spans", i, size)))
    rows = rows.withColumn("_blocks", blocks)
    done = F.aggregate("_blocks", F.struct(nothing.alias("out"), F.lit(0).alias("at")).cast(piece), block, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col("_text"), s["at"] + 1, F.char_length("_text") - s["at"])))
    text = F.when(F.size("spans") > 0, done).otherwise(F.col(f"_doc.`{text_col}`"))
    return rows.select(*[text.alias(c) if c == text_col else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
