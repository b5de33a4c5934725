"""Column rules over URLs: hosts and campaign attribution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that carry campaign attribution.
ATTRIBUTION_KEYS = (
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_content",
    "utm_term",
    "gclid",
    "fbclid",
    "msclkid",
    "ttclid",
    "li_fat_id",
    "twclid",
)

# Identifiers kept from a push payload; title and body never are.
PUSH_KEYS = (
    "campaign_id",
    "campaignId",
    "message_id",
    "messageId",
    "notification_id",
    "notificationId",
    "track_id",
    "trackId",
    "type",
    "category",
)


# Scheme, authority, path and query, whatever the characters in them.
_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/\\?#]*)?([^?#]*)(?:\?([^#]*))?"


def _part(url: Column, no: int) -> Column:
    return F.regexp_extract(url, _URL, no)


def _host(url: Column) -> Column:
    """The host as written, empty if there is none: after the last ``@`` of the authority, before its port."""
    return F.regexp_extract(_part(url, 2), r"^//(?:.*@)?(\[[^\]]*\]|[^:]*)", 1)


def _decoded(text: Column, plus: bool) -> Column:
    """Percent decoding that leaves broken escapes as they are; ``plus`` says whether it stands for a space."""
    whole = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    if not plus:
        whole = F.replace(whole, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(whole), text)


def host_of(url: Column) -> Column:
    """Lower-cased host of an absolute URL, null if it has none."""
    return F.when(_part(url, 1) != "", F.nullif(F.lower(_host(url)), F.lit("")))


def is_self_request(url: Column, host: Column | str | None) -> Column:
    if host is None:
        return F.lit(False)
    host = F.lit(host) if isinstance(host, str) else host
    return F.coalesce((host != "") & (host_of(url) == F.lower(host)), F.lit(False))


def extract_attribution(url: Column) -> Column:
    """Struct of url, host, decoded path and one field per attribution parameter.

    Names match whatever their case. Each spelling of a name counts once, by its first value, and the last
    spelling with a value wins; empty values are null. A URL such as ``mailto:a@b`` has neither host, path nor parameters.
    """
    opaque = (_part(url, 1) != "") & (_part(url, 2) == "") & ~_part(url, 3).startswith("/")
    query = F.when(~opaque, _part(url, 4))
    pairs = F.transform(
        F.split(query, "&"),
        lambda p: F.struct(
            _decoded(F.substring_index(p, "=", 1), plus=True).alias("k"),
            F.when(F.contains(p, F.lit("=")), _decoded(F.substr(p, F.instr(p, "=") + 1), plus=True)).alias("v"),
        ),
    )
    # Arrays of one element bind what is read again and again.
    wanted = F.filter(pairs, lambda p: F.lower(p["k"]).isin(*ATTRIBUTION_KEYS))
    firsts = F.flatten(
        F.transform(
            F.array(wanted),
            lambda all_: F.filter(all_, lambda p, i: F.array_position(F.transform(all_, lambda q: q["k"]), p["k"]) == i + 1),
        )
    )
    given = F.filter(firsts, lambda p: F.coalesce(p["v"], F.lit("")) != "")

    def value(name: str) -> Column:
        return F.try_element_at(F.filter(given, lambda p: F.lower(p["k"]) == name), F.lit(-1))["v"].alias(name)

    path = F.when(~opaque, F.nullif(_decoded(_part(url, 3), plus=False), F.lit("")))
    return F.struct(
        url.alias("url"),
        F.nullif(_host(url), F.lit("")).alias("host"),
        path.alias("path"),
        *[value(k) for k in ATTRIBUTION_KEYS],
    )


def deep_link_properties(url: Column, source: Column | None = None, action: Column | None = None, package: Column | None = None) -> Column:
    """Attribution as a property map, with the intent's action and package when given."""
    found = extract_attribution(url)
    names = ["url", "host", "path", *ATTRIBUTION_KEYS]
    pairs = [x for n in names for x in (F.lit(n), found[n])]
    if action is not None:
        pairs += [F.lit("action"), F.nullif(action, F.lit(""))]
    if package is not None:
        pairs += [F.lit("package"), F.nullif(package, F.lit(""))]
    if source is not None:
        pairs += [F.lit("source"), source]
    bag = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    return F.when(url.isNotNull(), bag)


def project_push(data: Column, action_id: Column | None = None) -> Column:
    """The identifiers of a push payload that may be recorded, plus the tapped action."""
    kept = F.map_filter(data, lambda k, v: k.isin(*PUSH_KEYS) & (v != ""))
    if action_id is None:
        return kept
    action = F.map_filter(F.create_map(F.lit("actionId"), action_id), lambda _, v: v.isNotNull())
    return F.map_concat(action, kept)
