"""Landed HTML pages -> metadata records, as regex column expressions.

Extracted per page (all JVM-side, no parser library, no UDF):

* ``title``: text of ``<title>``, site suffix removed (F11);
* ``heading``: text of the first ``<h1>``; ``first_link``: first ``<a href>``
  made absolute against the page URL (F13);
* portal fields: inside the ``data-search data-content`` blocks (the second
  block when there are two or more, else the first) every ``label``/``span``
  with class ``label`` names a field; its value is the first ``<p>`` or
  ``<a>`` of the next ``search-input`` div before another label, divs inside
  it included; the API field takes the first link of that div, made absolute;
  the rating field is skipped;
* ``updated_at_src``: the first ``yyyy/MM/dd HH:mm:ss`` inside a span that
  mentions the update-date label, searched in the ``data-title-wrapper``
  block first and then in the whole page (F12).

``complete`` is false when no update time was found; ``pages_to_metadata``
with ``require_update_time=True`` drops such pages, as the original does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.functions.text import let, strip_title_suffix, tag_text
from harvest.functions.urls import resolve_link

# Fixed label texts of the portal pages.
UPDATE_LABEL = "資料更新日期"
RATING_LABEL = "資料評分"
API_LABEL = "資料介接"
# Portal field label -> our column name.
FIELD_NAMES = {
    "資料分類": "category", "提供單位": "provider", "上架日期": "published",
    "更新頻率": "frequency", "資料描述": "description", "原始資料來源": "source", API_LABEL: "api_url",
}

TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
H1_RE = r"(?is)<h1[^>]*>(.*?)</h1>"
FIRST_HREF_RE = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""
CONTENT_BLOCK_RE = r"""(?is)<div[^>]*class\s*=\s*["']data-search data-content["'][^>]*>(.*?)(?=<div[^>]*class\s*=\s*["']data-search data-content["']|$)"""
LABEL_START_RE = r"""(?is)<(?:label|span)\b[^>]*class\s*=\s*["'](?:[^"']*\s)?label(?:\s[^"']*)?["'][^>]*>"""
LABEL_RE = r"(?is)^(.*?)</(?:label|span)>"
INPUT_RE = r"""(?is)<div[^>]*class\s*=\s*["'](?:[^"']*\s)?search-input(?:\s[^"']*)?["'][^>]*>(.*)$"""
DIV_START_RE, DIV_END_RE = r"(?i)<div\b", r"(?i)</div\s*>"
VALUE_RE = r"(?is)<(p|a)\b[^>]*>(.*?)</\1>"
WRAPPER_RE = r"""(?is)<div[^>]*class\s*=\s*["']data-title-wrapper["'][^>]*>(.*)$"""
SPAN_RE = r"(?is)<span\b[^>]*>(.*?)</span>"
STAMP_RE = r"(\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"


def _first(col: Column, pattern: str, group: int = 1) -> Column:
    return let(F.regexp_extract(col, pattern, group), lambda v: F.when(v != "", v))


def _inside_div(rest: Column) -> Column:
    """What of the text after a div's start tag lies inside it: up to the end tag that closes as many divs as begin. The
    depth is summed part by part and the parts inside are joined once, in time linear in the text, also if the div never ends."""
    def step(done: Column, part: Column) -> Column:
        more = F.struct((done["depth"] + F.regexp_count(part, F.lit(DIV_START_RE)) - 1).alias("depth"), (done["parts"] + 1).alias("parts"))
        return F.when(done["depth"] > 0, more).otherwise(done)

    def inside(parts: Column) -> Column:
        n = F.aggregate(parts, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("parts")), step)["parts"]
        return F.array_join(F.slice(parts, F.lit(1), n), "")

    return let(F.split(rest, DIV_END_RE), inside)


def _update_time(html: Column) -> Column:
    def in_spans(block: Column) -> Column:
        # span text (tags inside removed) that mentions the label, then its first stamp
        texts = F.transform(F.regexp_extract_all(block, F.lit(SPAN_RE), 1), lambda t: tag_text(t))
        labelled = F.filter(texts, lambda t: F.contains(t, F.lit(UPDATE_LABEL)))
        stamps = F.filter(F.transform(labelled, lambda t: F.regexp_extract(t, STAMP_RE, 1)), lambda t: t != "")
        return F.get(stamps, 0)
    wrapper = _inside_div(F.regexp_extract(html, WRAPPER_RE, 1))
    # A page that never mentions the label has no update time: skip the span scan.
    return F.when(F.contains(html, F.lit(UPDATE_LABEL)), F.coalesce(in_spans(wrapper), in_spans(html)))


def _value(url: Column, p: Column) -> Column:
    """Value of one (label, value-div) pair: the first <p>/<a> text; the API field
    takes the div's first link, made absolute."""
    div = p["v"]
    text = tag_text(F.regexp_extract(div, VALUE_RE, 2))
    has_tag = F.regexp_extract(div, VALUE_RE, 1) != ""
    link = F.when(p["k"] == API_LABEL, F.regexp_extract(div, FIRST_HREF_RE, 1)).otherwise("")
    return let(link, lambda l: F.when(l != "", resolve_link(url, l)).otherwise(F.when(has_tag, text)))


def with_portal_fields(df: DataFrame, html_col: str = "html", url_col: str = "url",
                       out_col: str = "_fields") -> DataFrame:
    """Add the label -> value map of the portal's metadata block.

    Built in stages (block, then pairs, then entries, then the map) so every
    regex runs once per page: each stage is its own projection, and the
    optimizer does not inline a non-cheap expression into several references.
    """
    # Pages without the metadata block skip the block regex.
    blocks = F.when(F.contains(F.col(html_col), F.lit("data-content")),
                    F.regexp_extract_all(F.col(html_col), F.lit(CONTENT_BLOCK_RE), 1)) \
        .otherwise(F.array().cast("array<string>"))
    s1 = df.withColumn("_blocks", blocks)
    s1 = s1.withColumn("_block", F.when(F.size("_blocks") > 1, F.get("_blocks", 1)).otherwise(F.get("_blocks", 0)))
    after_labels = F.slice(F.split("_block", LABEL_START_RE), 2, 1 << 30)
    s2 = s1.withColumn("_pairs", F.transform(F.filter(after_labels, lambda t: t.rlike(INPUT_RE)), lambda t: F.struct(
        tag_text(F.regexp_extract(t, LABEL_RE, 1)).alias("k"), _inside_div(F.regexp_extract(t, INPUT_RE, 1)).alias("v"))))
    pairs = F.filter("_pairs", lambda p: p["k"] != RATING_LABEL)
    url = F.col(url_col)
    s3 = s2.withColumn("_entries", F.transform(pairs, lambda p: F.struct(p["k"].alias("key"), _value(url, p).alias("value"))))
    s4 = s3.withColumn("_names", F.transform("_entries", lambda e: e["key"]))
    # A repeated label keeps its last value (later assignments win).
    last = F.filter("_entries", lambda e, i: F.size("_names") - F.array_position(F.reverse("_names"), e["key"]) == i)
    return s4.withColumn(out_col, F.map_from_entries(last)).drop("_blocks", "_block", "_pairs", "_entries", "_names")


def page_metadata(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All extracted fields per page (one row per page)."""
    html, url = F.col(html_col), F.col(url_col)
    href = _first(html, FIRST_HREF_RE)
    cols = [c for c in pages.columns if c != html_col]
    staged = with_portal_fields(pages, html_col, url_col).select(
        *cols,
        strip_title_suffix(tag_text(_first(html, TITLE_RE))).alias("title"),
        tag_text(_first(html, H1_RE)).alias("heading"),
        resolve_link(url, href).alias("first_link"),
        "_fields",
        _update_time(html).alias("updated_at_src"))
    out = staged.select(*cols, "title", "heading", "first_link",
                        *[F.element_at(F.col("_fields"), F.lit(label)).alias(name) for label, name in FIELD_NAMES.items()],
                        "updated_at_src")
    return out.withColumn("complete", F.col("updated_at_src").isNotNull())


def pages_to_metadata(pages: DataFrame, require_update_time: bool = True) -> DataFrame:
    md = page_metadata(pages)
    return md.where(F.col("complete")) if require_update_time else md
