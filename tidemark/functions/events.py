"""Column functions over edit events. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The automatic revert summaries of twelve language groups, which results depend on.
REVERT_PHRASES = {
    "en": r"(?:^|\W)(?:revert(?:ed|ing)?|undid revision|undo|rv[tv]?|rollback)(?:\W|$)",
    "wikidata": r"/\* (?:undo|restore):",
    "de": r"rückgängig gemacht|\bwurde verworfen\b",
    "es_pt": r"\brevertid[oa]s?\b|\bdeshecha la edici[oó]n|\bdesfeita a edi[cç][aã]o",
    "fr": r"\br[ée]vocation des modifications|\bannulation de la (?:\[\[[^\]|]*\|)?modification",
    "it": r"\bannullat[ae] l[ae] modific",
    "nl": r"\bongedaan gemaakt\b",
    "pl": r"\bwycofano (?:edycj|ostatni)|\banulowanie wersji",
    "cs": r"vr[aá]cen[ya]? do předchozího stavu",
    "ru": r"\bотмена правки\b|\bоткат правок\b",
    "zh": r"回退|撤销|撤銷|還原|还原",
    "ja": r"取り消し|巻き戻し",
}
#: U makes word characters and case Unicode's; i alone folds ASCII only.
REVERT_REGEX = "(?iU)" + "|".join(f"(?:{p})" for p in REVERT_PHRASES.values())
#: What Unicode, beyond Java's \s, calls white space.
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]+"


def is_revert_comment(comment: Column) -> Column:
    return F.coalesce(comment, F.lit("")).rlike(REVERT_REGEX)


def is_revert(kind: Column, comment: Column) -> Column:
    """Only an edit is a revert."""
    return (kind == "edit") & is_revert_comment(comment)


def collapsed(text: Column) -> Column:
    """White space runs become one space; none at either end."""
    return F.trim(F.regexp_replace(text, BLANK, " "))


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^{BLANK}|{BLANK}$", "")


def page_key(wiki: Column, title: Column) -> Column:
    return F.concat(wiki, F.lit(":"), title)


def size_change(old: Column, new: Column) -> Column:
    """Null if either is."""
    return new - old


def alert_id(wiki: Column, title: Column, first_event_id: Column) -> Column:
    """The same war has the same id however often it is found."""
    zero = F.lit("\x00")
    return F.substring(F.sha2(F.concat(wiki, zero, title, zero, first_event_id), 256), 1, 32)


def page_url(server: Column, title: Column) -> Column:
    """The page's address, percent-encoded but for : / ( ) _ , ! ~ * and ', spaces as underscores; null without a server."""
    path = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for code, char in (("%3A", ":"), ("%2F", "/"), ("%28", "("), ("%29", ")"), ("%2C", ","), ("%21", "!"), ("%7E", "~"), ("%27", "'"), ("+", "%20")):
        path = F.replace(path, F.lit(code), F.lit(char))
    return F.when(F.length(server) > 0, F.concat(F.lit("https://"), server, F.lit("/wiki/"), path))


def iso(ts: Column) -> Column:
    """ISO 8601 with microseconds and offset; null stays null."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without a zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def millis(ts: Column) -> Column:
    return F.floor(micros(ts) / 1000).cast("long")


def minute_ms(ms: Column) -> Column:
    """The start of the minute, in milliseconds, before 1970 too."""
    return ms - F.pmod(ms, F.lit(60_000))


def from_millis(ms: Column) -> Column:
    """A timestamp without a zone."""
    return F.timestamp_add("MILLISECOND", ms, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def share(part: Column, whole: Column, places: int = 4) -> Column:
    """part / whole, rounded; 0 of nothing."""
    return F.when(whole > 0, F.round(part / whole, places)).otherwise(F.lit(0.0))


def partition_of(key: Column, partitions: int) -> Column:
    """The partition a log with CRC32 partitioning puts a key in."""
    return F.pmod(F.crc32(key), F.lit(partitions)).cast("int")


def human_millis(ms: Column) -> Column:
    """Milliseconds as ms, s or min, for reports."""
    return (
        F.when(ms.isNull(), "-").when(ms < 1000, F.format_string("%.0f ms", ms.cast("double")))
        .when(ms < 60_000, F.format_string("%.1f s", ms / 1000)).otherwise(F.format_string("%.1f min", ms / 60_000))
    )


#: Hosts of sites whose names have a form of their own.
SPECIAL_HOSTS = {
    "commonswiki": "commons.wikimedia.org",
    "wikidatawiki": "www.wikidata.org",
    "metawiki": "meta.wikimedia.org",
    "specieswiki": "species.wikimedia.org",
    "mediawikiwiki": "www.mediawiki.org",
}
#: What site names end in.
PROJECTS = ("wiki", "wiktionary", "wikisource", "wikibooks", "wikinews", "wikiquote", "wikivoyage", "wikiversity")


def site_host(wiki: Column) -> Column:
    """The host of a site by its database name, such as enwiki or frwiktionary; null if the name has no known form."""
    form = f"^([a-z_-]+?)({'|'.join(PROJECTS)})$"
    language, project = F.regexp_extract(wiki, form, 1), F.regexp_extract(wiki, form, 2)
    domain = F.when(project == "wiki", "wikipedia").otherwise(project)
    host = F.when(F.length(language) > 0, F.concat(F.translate(language, "_", "-"), F.lit("."), domain, F.lit(".org")))
    special = F.create_map(*(F.lit(x) for pair in SPECIAL_HOSTS.items() for x in pair))
    return F.coalesce(F.element_at(special, wiki), host)


def site_url(wiki: Column, title: Column) -> Column:
    """A page's address from its site's name alone: only : and / stay as they are besides what never needs encoding."""
    path = F.url_encode(F.translate(title, " ", "_"))
    for code, char in (("%3A", ":"), ("%2F", "/"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~"), ("+", "%20")):
        path = F.replace(path, F.lit(code), F.lit(char))
    return F.concat(F.lit("https://"), site_host(wiki), F.lit("/wiki/"), path)


def percent(fraction: Column, digits: int = 0) -> Column:
    return F.when(fraction.isNull(), "n/a").otherwise(F.format_string(f"%.{digits}f%%", fraction * 100))


def signed_size(change: Column) -> Column:
    """A change in bytes with its sign, as histories show it."""
    digits = F.format_number(F.abs(change), 0)
    return F.when(change.isNull(), "").when(change == 0, "0").otherwise(F.concat(F.when(change > 0, "+").otherwise("−"), digits))


def duration(ms: Column) -> Column:
    """Milliseconds in the largest unit below which they fall: ms, s, min, h or days."""
    text = F.format_string("%.1f days", ms / 86_400_000)
    for limit, form, unit in ((86_400_000, "%.1f h", 3_600_000), (3_600_000, "%.0f min", 60_000), (60_000, "%.1f s", 1000), (1000, "%.0f ms", 1)):
        text = F.when(ms < limit, F.format_string(form, (ms / unit).cast("double"))).otherwise(text)
    return F.when(ms.isNull(), "n/a").otherwise(text)


def compact_count(n: Column) -> Column:
    """A count in full below ten thousand, else in thousands (K), millions (M) and so on to one place."""
    size = F.abs(n).cast("double")
    text = F.format_number(F.round(n.cast("double")), 0)
    for unit, name in ((1e3, "K"), (1e6, "M"), (1e9, "B"), (1e12, "T")):
        least = 1e4 if unit == 1e3 else 0.99995 * unit  # from there on the smaller unit would round up to 1000
        short = F.regexp_replace(F.format_string("%.1f", F.round(n / unit, 1).cast("double")), r"\.0$", "")
        text = F.when(size >= least, F.concat(short, F.lit(name))).otherwise(text)
    return F.coalesce(text, F.lit("n/a"))


def rate_text(per_second: Column) -> Column:
    """A rate to one place, whole from 100 on."""
    short = F.format_string("%.1f", per_second.cast("double"))
    return F.when(per_second.isNull(), "n/a").when(per_second >= 100, F.format_number(F.round(per_second), 0)).otherwise(short)


def ago(at_ms: Column, now_ms: Column) -> Column:
    """How long ago a moment was; moments to come and the last 1.5 s are now."""
    age = F.greatest(now_ms - at_ms, F.lit(0))
    return F.when(at_ms.isNull(), "never").when(age < 1500, "just now").otherwise(F.concat(duration(age), F.lit(" ago")))


def clock(ts: Column) -> Column:
    return F.coalesce(F.date_format(ts, "HH:mm:ss"), F.lit(""))


def group_status(lag: Column, members: Column) -> Column:
    """How a consumer group does: stopped without members, else behind or caught up."""
    return F.when(members.isNull() | (members == 0), "stopped").when(lag > 1, "behind").otherwise("caught up")
