"""URL filters with redirect equivalence, in DataFrame functions only.

Rules of a host and a path prefix decide urls directly; the longest that fits wins. Urls that redirect to each other
or name each other as canonical are one resource: connected components over these links carry a block to all
aliases that no rule decides, unless a rule allows one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarryline.llm.common import connected_components, pinned

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed value: scheme and rest, host, path of a url.
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# How markup splits into tags. A quote opens a value only after a sign of equality; whatever is left open ends
# with the page, so every pattern passes over a page once.
TAG_REST = r"""(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=)*+(?:>|.*+)"""
COMMENT = r"<!--(?:-?>|.*?--!?>|.*+)"
RAW = rf"<(script|style|textarea|title|xmp|iframe|noembed|noframes)(?=[\s/>]){TAG_REST}(?:.*?</\1(?=[\s/>])|.*+)"
NAMED_TAGS = rf"(?is){COMMENT}|{RAW}|(<(?:link|meta|base)(?=[\s/>]){TAG_REST})|<[a-z/!?]{TAG_REST}"
ATTRIBUTE = r"""(?s)[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]++))?+"""
REFRESH_TARGET = r"(?is)^\s*+[0-9.]*+(?:\s*+[;,]\s*+|\s++)(?:url\s*=\s*)?(?:\"([^\"]*)\"?|'([^']*)'?|(\S.*))"
REFERENCE = r"(?s)&#[xX][0-9a-fA-F]++;?|&#[0-9]++;?|&[A-Za-z]++;|[^&]++|&"
# Names of the ASCII signs that urls hold.
NAMED_REFERENCES = {
    "&excl;": "!", "&quot;": '"', "&num;": "#", "&dollar;": "$", "&percnt;": "%", "&amp;": "&", "&apos;": "'",
    "&lpar;": "(", "&rpar;": ")", "&ast;": "*", "&plus;": "+", "&comma;": ",", "&period;": ".", "&sol;": "/",
    "&colon;": ":", "&semi;": ";", "&lt;": "<", "&equals;": "=", "&gt;": ">", "&quest;": "?", "&commat;": "@",
    "&lsqb;": "[", "&bsol;": "\\", "&rsqb;": "]", "&lowbar;": "_", "&Tab;": "\t", "&NewLine;": "\n",
}


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """A url as a resource: scheme and host in lower case, without fragment; null without host."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^(.*?://[^/?#]*)", 1)
    tail = F.substring(bare, F.length(head) + 1, F.length(bare))
    return F.when(host_of(url) != "", F.concat(F.translate(head, UPPER, LOWER), tail))


def decoded(text: Column) -> Column:
    """Character references of a text as characters: numbers, and the names of ASCII signs; others stay as they are."""
    names = F.create_map(*[F.lit(x) for pair in NAMED_REFERENCES.items() for x in pair])

    def character(piece: Column) -> Column:
        hexadecimal = piece.rlike("^&#[xX]")
        digits = F.regexp_replace(piece, "^&#[xX]?0*|;$", "")
        number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(F.conv(digits, 10, 10))
        # A number that is no character becomes the replacement character.
        number = F.when((F.length(digits) > 7) | (digits == ""), 0).otherwise(number.cast("long"))
        wrong = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
        word = F.unhex(F.lpad(F.hex(F.when(wrong, 0xFFFD).otherwise(number)), 8, "0"))
        return F.when(piece.startswith("&#") & (F.length(piece) > 2), F.decode(word, "UTF-32")).otherwise(F.coalesce(names[piece], piece))

    pieces = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(pieces, character), "")).otherwise(text)


def attribute(tag: Column, name: str) -> Column:
    """An attribute's first value in a tag, as written without its quotes; null without the attribute."""
    parts = F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0))
    first = F.get(F.filter(parts, lambda part: part.rlike(rf"(?is)^{name}\s*(?:=|$)")), F.lit(0))
    value = F.regexp_replace(first, r"(?s)^[^=]*(?:=\s*|$)", "")
    return F.when(value.rlike("^[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def without_dots(path: Column) -> Column:
    """A path without its segments ``.`` and ``..``."""
    segments = F.split(path, "/", -1)
    here, above = r"(?i)^(?:\.|%2e)$", r"(?i)^(?:\.|%2e){2}$"

    def step(done: Column, segment: Column) -> Column:
        # The first entry stands before the first slash and stays.
        parent = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(segment.rlike(above), parent).when(segment.rlike(here), done).otherwise(F.concat(done, F.array(segment)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    last = F.element_at(segments, -1)
    ends = F.when(last.rlike(here) | last.rlike(above), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"(?i)(?:^|/)(?:\.|%2e){1,2}(?:/|$)"), F.array_join(ends, "/")).otherwise(path)


def resolved(rows: DataFrame, link: str, base: str) -> DataFrame:
    """Rows whose column ``link`` is made an absolute url without dot segments; null stays null.

    Intermediate results are columns, so that no expression is written out again at every place that uses it.
    """
    bare = F.regexp_replace(F.regexp_replace(link, r"(?s)^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\n\r]", "")
    page = F.regexp_extract(base, r"(?s)^(.*?://[^?#]*)", 1)
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"(?s)^(.*?)://", 1)
    parts = rows.withColumns({"_bare": bare, "_page": page, "_origin": origin, "_scheme": scheme})
    bare, page = F.col("_bare"), F.col("_page")
    folder = F.regexp_replace(page, r"(?s)(?<!:)(?<!/)/[^/]*$", "")
    whole = (
        F.when(bare.rlike(r"(?s)^[A-Za-z][A-Za-z0-9+.-]*:"), bare)
        .when(bare.startswith("//"), F.concat("_scheme", F.lit(":"), bare))
        .when(bare.startswith("/"), F.concat("_origin", bare))
        .when(bare.startswith("?"), F.concat(page, bare))
        .when((bare == "") | bare.startswith("#"), F.col(base))
        .otherwise(F.concat(folder, F.lit("/"), bare))
    )
    parts = parts.withColumn("_whole", whole)
    head, path = F.regexp_extract("_whole", r"(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract("_whole", PARTS, 2)
    parts = parts.withColumns({"_head": head, "_path": path})
    tail = F.substring("_whole", F.length("_head") + F.length("_path") + 1, F.length("_whole"))
    clean = F.concat("_head", without_dots(F.col("_path")), tail)
    done = parts.withColumn(link, F.when(F.col("_head") == "", F.col("_whole")).otherwise(clean))
    return done.drop("_bare", "_page", "_origin", "_scheme", "_whole", "_head", "_path")


def alias_links(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """Links (a, b) between a page's url and the urls that its markup redirects to or names as canonical.

    These are ``<link>`` tags whose ``rel`` holds the word canonical and ``<meta http-equiv=refresh>`` tags. Comments, and
    the text of scripts, styles, titles and the like, hold no tags. The first value of an attribute counts, character references
    are decoded, and links are resolved against the page's first ``<base href>``. Pages without url have no links.
    """
    tags = F.filter(F.regexp_extract_all(F.col(page), F.lit(NAMED_TAGS), F.lit(2)), lambda tag: tag != "")
    # References may hide letters of either word.
    likely = F.col(page).rlike(r"(?i)canonical|refresh|&#") & F.col(page).rlike(r"(?i)<(?:link|meta)[\s/]")
    tagged = pages.where(likely & F.col(url).isNotNull()).select(F.col(url).alias("address"), tags.alias("tags"))
    # Written, as exploding it would otherwise look for the tags of a page twice.
    tagged = pinned(tagged.where(F.size("tags") > 0), "tags")
    bases = F.filter("tags", lambda tag: tag.rlike("(?i)^<base") & attribute(tag, "href").isNotNull())
    listed = tagged.select("address", F.get(bases, F.lit(0)).alias("base"), F.explode("tags").alias("tag"))
    listed = listed.withColumn("meta", F.col("tag").rlike("(?i)^<meta")).where(~F.col("tag").rlike("(?i)^<base"))
    named = listed.select(
        "address",
        "meta",
        attribute(F.col("base"), "href").alias("base"),
        F.when(F.col("meta"), attribute(F.col("tag"), "http-equiv")).otherwise(attribute(F.col("tag"), "rel")).alias("role"),
        F.when(F.col("meta"), attribute(F.col("tag"), "content")).otherwise(attribute(F.col("tag"), "href")).alias("value"),
    )
    role = F.trim(F.lower(decoded(F.col("role"))))
    read = named.select(
        "address", "meta", decoded(F.col("base")).alias("base"), role.alias("role"), decoded(F.col("value")).alias("value")
    )
    canonical = ~F.col("meta") & F.array_contains(F.split("role", r"\s+"), "canonical")
    target = F.concat(*[F.regexp_extract("value", REFRESH_TARGET, i) for i in (1, 2, 3)])
    link = F.when(canonical, F.col("value")).when(F.col("meta") & (F.col("role") == "refresh"), target)
    # Most tags are of other kinds: what names a url is written, and only that is resolved.
    pointed = pinned(read.select("address", "base", link.alias("link")).where("link != ''"), "links")
    based = resolved(pointed, "base", "address").withColumn("base", F.coalesce("base", "address"))
    ends = resolved(based, "link", "base")
    return pinned(ends.select(node_of(F.col("address")).alias("a"), node_of(F.col("link")).alias("b")), "links")


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and ``rules``: all rules of the host or a domain above it, longest first, allow before block."""
    listed = rules.select(
        F.translate("host", UPPER, LOWER).alias("rule_host"), F.col("path").alias("rule_path"), "verdict"
    ).where("rule_host is not null and rule_path is not null and verdict in ('allow', 'block')")
    deepest = listed.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    ends = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(deepest, 1)))),
        lambda n: F.array_join(F.slice(labels, -n, n), "."),
    )
    suffixes = hosts.where("host != ''").select("host", F.explode(ends).alias("rule_host"))
    rule = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.length("rule_host").alias("host_size"),
        (F.col("verdict") == "allow").alias("allows"),
        F.col("rule_path").alias("path"),
        F.concat("rule_host", "rule_path").alias("rule"),
        "verdict",
    )
    # As many entries as rules fit a host.
    fits = suffixes.join(listed, "rule_host").groupBy("host").agg(F.collect_set(rule).alias("rules"))
    return fits.select("host", F.sort_array("rules", asc=False).alias("rules"))


def decided(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows with ``host`` and ``path``, and ``rule`` and ``ruled``: the longest rule that fits and its verdict."""
    known = rules_by_host(rows.select("host").distinct(), rules)
    joined = rows.join(known, "host", "left")
    best = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    return joined.withColumn("best", best).withColumns({"rule": F.col("best.rule"), "ruled": F.col("best.verdict")}).drop("rules", "best")


def url_verdicts(
    pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, key: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """Verdict of every row: ``key``, ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). ``links`` (a, b) are urls of one resource; by
    default those the pages' markup shows. A rule decides its urls alone. Other urls are blocked when a rule blocks
    an alias and no rule allows one, else allowed. Of rules of equal length the one with the longer host wins, then
    the one that allows. Null urls and urls without ``://`` have an empty host and path, no rule, no alias, and
    are allowed. Null keys and repeated rows are kept; null pages have no links. Rules with null parts or other
    verdicts do not count. Empty tables give no rows. Other columns are not looked at.
    """
    if links is None:
        links = alias_links(pages, url, page)
    roots = connected_components(links)
    named = roots.select("root", "node", host_of(F.col("node")).alias("host"), path_of(F.col("node")).alias("path"))
    votes = decided(named, rules).groupBy("root").agg(
        F.max(F.col("ruled") == "allow").alias("allows"), F.max(F.col("ruled") == "block").alias("blocks")
    )
    blocked = votes.where("blocks and not coalesce(allows, false)").select("root")
    aliases = roots.join(blocked, "root").select("node", F.lit("block").alias("inherited"))
    column = F.col(url)
    rows = pages.select(F.col(key).alias("key"), host_of(column).alias("host"), path_of(column).alias("path"), node_of(column).alias("node"))
    judged = decided(rows, rules).join(aliases, "node", "left")
    verdict = F.coalesce("ruled", "inherited", F.lit("allow"))
    return judged.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"))
