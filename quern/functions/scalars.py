"""Column expressions for links, text forms, dates and scores. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Pounds to kilograms, and the day number of 1970-01-01 counted from 0001-01-01 = 1.
KG_PER_POUND = 0.453592
ORDINAL_OF_EPOCH = 719163


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Character references decoded in link targets; the ampersand comes last.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def links(html: str | Column) -> Column:
    """Targets of all anchors, in page order: double-quoted, single-quoted or bare, with references decoded."""
    target = r"""(?is)<a\b[^>]*?\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""

    def plain(h: Column) -> Column:
        h = F.regexp_replace(h, "^[\"']|[\"']$", "")
        for reference, character in REFERENCES:
            h = F.replace(h, F.lit(reference), F.lit(character))
        return h

    return F.transform(F.regexp_extract_all(_col(html), F.lit(target), F.lit(1)), plain)


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.posexplode(links(html)).alias("pos", "href"))


def match_links(
    pages: DataFrame, pattern: str, html: str = "html", group: int = 0, first: bool = False
) -> DataFrame:
    """Matches of ``pattern`` in the page text, all in order or only the first per page."""
    found = F.regexp_extract_all(_col(html), F.lit(pattern), F.lit(group))
    if first:
        found = F.slice(found, 1, 1)
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.posexplode(found).alias("pos", "match"))


def _without_dots(url: Column) -> Column:
    """Resolve ``.`` and ``..`` in the path of an address."""
    site = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)
    tail = F.regexp_extract(url, r"([?#].*)$", 1)
    parts = F.split(path, "/")
    up = lambda a: F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))
    kept = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda a, s: F.when(s == ".", a).when(s == "..", up(a)).otherwise(F.concat(a, F.array(s))),
    )
    end = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    resolved = F.concat(site, F.lit("/"), F.array_join(F.concat(kept, end), "/"), tail)
    return F.when(path.rlike(r"/\.\.?(/|$)"), resolved).otherwise(url)


def absolute_url(base: str | Column, href: str | Column) -> Column:
    """Join a link to the address of its page; ``.`` and ``..`` are resolved."""
    b, h = _col(base), _col(href)
    plain = F.regexp_replace(b, r"[?#].*$", "")
    scheme = F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    site = F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    folder = F.when(plain == site, F.concat(site, F.lit("/"))).otherwise(
        F.regexp_replace(plain, r"[^/]*$", "")
    )
    return _without_dots(
        F.when(h == "", b)
        .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, h))
        .when(h.startswith("/"), F.concat(site, h))
        .when(h.startswith("#"), F.concat(F.regexp_replace(b, r"#.*$", ""), h))
        .when(h.startswith("?"), F.concat(plain, h))
        .otherwise(F.concat(folder, h))
    )


def file_name(url: str | Column) -> Column:
    return F.regexp_extract(_col(url), "([^/]*)$", 1)


def file_ext(name: str | Column) -> Column:
    """Lower-cased suffix with its dot, empty when there is none."""
    return F.regexp_extract(F.lower(file_name(name)), r"[^.](\.[^.]+)$", 1)


def url_quote(path: str | Column) -> Column:
    """Percent-encoding that keeps slashes."""
    coded = F.replace(F.url_encode(_col(path)), F.lit("%2F"), F.lit("/"))
    coded = F.replace(F.replace(coded, F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~"))
    return F.replace(coded, F.lit("*"), F.lit("%2A"))


def covers_to_dates(df: DataFrame, covers: str = "Covers") -> DataFrame:
    """``April 2023 – September 2023`` to the first day of the first and the last of the second month."""
    parts = F.split(F.col(covers), "–")

    def month(i: int) -> Column:
        text = F.trim(F.regexp_replace(F.get(parts, F.lit(i)), r"\s+", " "))
        return F.to_date(F.try_to_timestamp(F.concat(F.lit("01-"), text), F.lit("dd-MMMM yyyy")))

    return df.withColumns({"Start_date": month(0), "End_Date": F.last_day(month(1))})


def format_season(season: str | Column) -> Column:
    """``Summer 2023`` to ``Sum 23``, ``Q1 2023`` to ``Q123``, ``Winter 2023/24`` to ``Win 23``."""
    s = _col(season)
    return (
        F.when(s.rlike("^Summer"), F.concat(F.lit("Sum "), F.right(s, F.lit(2))))
        .when(s.rlike(r"^Q\d"), F.concat(F.left(s, F.lit(2)), F.right(s, F.lit(2))))
        .when(s.rlike("^Winter"), F.concat(F.lit("Win "), F.right(F.substring_index(s, "/", 1), F.lit(2))))
        .otherwise(s)
    )


def previous_month_name(date: str | Column) -> Column:
    return F.date_format(F.add_months(_col(date), -1), "MMMM")


def date_ordinal(date: str | Column) -> Column:
    """Day number counted from 0001-01-01 = 1."""
    return F.unix_date(_col(date).cast("date")) + F.lit(ORDINAL_OF_EPOCH)


def weight_midpoint_kg(lo: str | Column, hi: str | Column) -> Column:
    return (_col(lo) + _col(hi)) / 2 * KG_PER_POUND


def _bound(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, which may name it many times."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(scores: str | Column) -> Column:
    """Shares of the exponentials, shifted by the largest score so that they cannot overflow."""
    v = _col(scores).cast("array<double>")
    raised = _bound(F.array_max(v), lambda top: F.transform(v, lambda x: F.exp(x - top)))
    return _bound(
        raised,
        lambda r: _bound(
            F.aggregate(r, F.lit(0.0), lambda a, x: a + x), lambda t: F.transform(r, lambda x: x / t)
        ),
    )


def to_base64(column: str | Column) -> Column:
    return F.base64(_col(column))


def scored_confidence(df: DataFrame, prob: str, name: str = "class_index") -> DataFrame:
    """Best class of a probability array and its percentage with one decimal."""
    p = F.col(prob)
    return df.withColumns(
        {
            name: (F.array_position(p, F.array_max(p)) - 1).cast("int"),
            "confidence": F.round(F.array_max(p) * 100, 1),
        }
    )
