"""Links of HTML pages as Catalyst expressions: tags, attributes, character references, base addresses.

A page is cut into tokens by one pattern. Comments and elements whose content is no markup (scripts,
styles and the like) are tokens of their own, so that nothing inside them counts as a tag. Attributes may
be quoted in either way, unquoted or without a value; of a repeated attribute the first counts.

Addresses are resolved against the page's first ``base`` element with a target, and that against the
page's own address. A NULL page has no links; an anchor without ``href`` is no link; an unfinished tag,
comment or script at the end of a page is no token, as browsers drop it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements whose content is text up to their end tag, and the named references decoded.
RAW_TEXT = ["script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes"]
REFERENCES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " "}

SPACE = r"[\x20\t\n\r\f]"
_VALUE = rf"""(?:"[^"]*+"|'[^']*+'|(?!["'])[^\x20\t\n\r\f>]++)"""
_NAME = r"[^\x20\t\n\r\f/>=][^\x20\t\n\r\f/>=]*+"
_INSIDE = rf"(?:[\x20\t\n\r\f/]++|{_NAME}(?:{SPACE}*+={SPACE}*+{_VALUE}?+)?+|=)*+"
# Comments, elements of raw text with their content, and the start tags looked for.
TOKEN = (
    rf"(?is)<!--(?:-?>|.*?--!?>|.*\z)|<({'|'.join(RAW_TEXT)})(?=[\x20\t\n\r\f/>]){_INSIDE}>.*?(?:</\1(?=[\x20\t\n\r\f/>])|\z)"
    rf"|</?[a-z][^\x20\t\n\r\f/>]*+{_INSIDE}>|<[!?/][^>]*+>"
)
ATTRIBUTE = rf"(?s)({_NAME})(?:{SPACE}*+={SPACE}*+({_VALUE})?+)?+"
ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tags(html: Column, name: str) -> Column:
    """The start tags of one element, whole and in order, as an array of texts."""
    found = F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: t.rlike(rf"(?is)^<{name}[\x20\t\n\r\f/>]"))


def attribute(tag: Column, name: str) -> Column:
    """Value of the first attribute of that name, references decoded; empty without a value, NULL without the attribute."""
    inside = F.regexp_replace(tag, r"(?s)^<[A-Za-z][^\x20\t\n\r\f/>]*+|>$", "")
    whole = F.regexp_extract_all(inside, F.lit(ATTRIBUTE), F.lit(0))
    own = F.get(F.filter(whole, lambda x: x.rlike(rf"(?is)^{name}(?:[\x20\t\n\r\f=]|\z)")), F.lit(0))
    value = F.regexp_extract(own, ATTRIBUTE, 2)
    return _bound(F.regexp_replace(value, r"""(?s)^"(.*)"$|^'(.*)'$""", "$1$2"), decoded)


def decoded(text: Column) -> Column:
    """The text with numeric references and the named ones of ``REFERENCES`` decoded, each once; others stay."""
    named = F.create_map(*[F.lit(x) for pair in REFERENCES.items() for x in pair])

    def piece(p: Column, at: Column) -> Column:
        decimal = F.regexp_extract(p, r"^#([0-9]{1,7})", 1).try_cast("long")
        hexadecimal = F.conv(F.nullif(F.regexp_extract(p, r"^#[xX]([0-9A-Fa-f]{1,6})", 1), F.lit("")), 16, 10).try_cast("long")

        def number(code: Column) -> Column:
            char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
            after = F.regexp_replace(p, r"^#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});?", "")
            return F.when((code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF), F.concat(char, after))

        letters = F.concat(F.element_at(named, F.regexp_extract(p, r"^([a-z]+);", 1)), F.regexp_replace(p, r"^[a-z]+;", ""))
        numbered = F.when(p.startswith("#"), _bound(F.coalesce(decimal, hexadecimal), number))
        return F.when(at == 0, p).otherwise(F.coalesce(numbered, letters, F.concat(F.lit("&"), p)))

    pieces = F.split(text, "&", -1)
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def _parts(url: Column) -> dict[str, Column]:
    """Scheme with colon, authority with slashes, path, query with its mark: what a relative address starts from."""
    plain = F.regexp_replace(url, r"(?s)#.*", "")
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?]*)?([^?]*)(\?.*)?$"
    return {n: F.regexp_extract(plain, pattern, k) for k, n in enumerate(("scheme", "host", "path", "query"), 1)}


def without_dots(path: Column) -> Column:
    """The path with ``.`` and ``..`` steps carried out."""
    steps = F.split(path, "/", -1)
    last = F.element_at(steps, -1)

    def step(done: Column, s: Column) -> Column:
        up = F.when(F.size(done) > 1, F.slice(done, F.lit(1), F.size(done) - 1)).otherwise(done)
        return F.when(s == "..", up).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

    kept = F.aggregate(steps, F.array().cast("array<string>"), step)
    closed = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.array_join(closed, "/")).otherwise(path)


def resolved(link: Column, base: Column) -> Column:
    """The address a link means on a page with that base address; without a base the link as it is."""
    link = F.regexp_replace(link, r"^[\x00-\x20]+|[\x00-\x20]+$|[\t\n\r]", "")
    of = _parts(base)
    own = F.regexp_extract(link, r"(?s)^([^?#]*)", 1)
    rest = F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    root = F.concat(of["scheme"], of["host"])
    folder = F.when((of["host"] != "") & (of["path"] == ""), "/").otherwise(F.regexp_replace(of["path"], r"[^/]*$", ""))
    return (
        F.when(base.isNull() | link.rlike(ABSOLUTE), link)
        .when(link.startswith("//"), F.concat(of["scheme"], link))
        .when(own.startswith("/"), F.concat(root, without_dots(own), rest))
        .when(own != "", F.concat(root, without_dots(F.concat(folder, own)), rest))
        .when(link.startswith("?"), F.concat(root, of["path"], link))
        .otherwise(F.concat(root, of["path"], of["query"], rest))
    )


def anchors(pages: DataFrame, html: str = "html", url: str | None = None) -> DataFrame:
    """One row per anchor with a target: the other columns, and ``link`` as written, references decoded.

    With ``url``, the column of the page's own address, ``address`` is added: the link resolved.
    """
    others = [F.col(c) for c in pages.columns if c != html]

    def targets(name: str) -> Column:
        return F.filter(F.transform(tags(F.col(html), name), lambda t: attribute(t, "href")), lambda h: h.isNotNull())

    # The outer form: before the inner one Spark would test the array for its size, cutting the page up again.
    if url is None:
        return pages.select(*others, F.explode_outer(targets("a")).alias("link")).where("link is not null")
    rows = pages.select(*others, F.get(targets("base"), F.lit(0)).alias("_base"), F.explode_outer(targets("a")).alias("link"))
    base = F.when(F.col("_base").isNull(), F.col(url)).otherwise(resolved(F.col("_base"), F.col(url)))
    return rows.where("link is not null").withColumn("address", resolved(F.col("link"), base)).drop("_base")
