"""Recall alerts from crawled listing pages (page_id or url, html) -> one row per alert.

Three layouts are tried per page, the first that has rows wins: a four-column table, list rows
(``views-row``), any table in the main area. Everything is built-in regular-expression functions on
whole pages; there is no document tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recallspark.functions import rules as R
from recallspark.functions.dates import parse_page_date
from recallspark.functions.text import blank_to_null, contains_any, markup_text, once, settled

def _attribute(name: str, value: str) -> str:
    """An attribute with a value in double, single or no quotes; ``value`` is a pattern for some of it."""
    return rf"""{name}\s*=\s*(?:"[^"]*{value}[^"]*"|'[^']*{value}[^']*'|[^\s"'>]*{value}[^\s"'>]*)"""


def _classed(names: str) -> str:
    return _attribute("class", rf"(?<![\w-])(?:{names})(?![\w-])")


# fixed values: markup of the listing pages
_TABLE4 = rf"(?is)<table\b[^>]*{_classed('cols-4')}[^>]*>.*?</table>"
_MAIN = r"(?is)<main\b[^>]*>.*?</main>"
_BODY = r"(?is)<tbody\b[^>]*>.*?</tbody>"
_BODY_ROWS = r"(?is)<tr\b[^>]*>.*?</tr>"
_CELL = r"(?is)<td\b[^>]*>(.*?)</td>"
_LIST_AREA = rf"(?is){_classed('view-content')}.*$"
_LIST_ROW = rf"(?is)<(?:div|li|tr|article)\b[^>]*{_classed('views-row')}[^>]*>"
# a list row is cut before every opening and behind every closing tag of the elements it can be
_ROW_EDGE = r"(?i)(?=<(?:div|li|tr|article)\b)|(?<=</div>)|(?<=</li>)|(?<=</tr>)|(?<=</article>)"
_ROW_OPEN, _ROW_CLOSE = r"(?i)^<(?:div|li|tr|article)\b", r"(?i)</(?:div|li|tr|article)>$"
_HREF = r"""(?is)^<a\b[^>]*\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
_TITLE = rf"(?is)(?:<h3\b[^>]*>|{_classed('views-field-title|field-content')}[^>]*>).*?(<a\b[^>]*>.*?</a>)"
_ANCHOR = r"(?is)(<a\b[^>]*>.*?</a>)"
NO_COMPANY, NO_REASON = "Unknown", "See FDA website for details"


def _field(classes: str) -> str:
    return rf"(?is)<([a-z0-9]+)\b[^>]*{_classed(classes)}[^>]*>(.*?)</\1>"


_DATE_FIELD = _field("views-field-created|date-display-single")
_TIME = r"(?is)<time\b[^>]*>(.*?)</time>"
_COMPANY_FIELD = _field("views-field-field-company|views-field-field-recall-firm")


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group)


def infer_product_type(description: Column, brand: Column) -> Column:
    lowered = F.lower(F.concat_ws(" ", F.coalesce(description, F.lit("")), F.coalesce(brand, F.lit(""))))
    return once(lowered, lambda text: F.when(contains_any(text, R.WEB_DRUG_WORDS), "Drugs")
                .when(contains_any(text, R.WEB_DEVICE_WORDS), "Devices").otherwise("Food"))


def pseudo_id(day_text: Column, company: Column, product: Column) -> Column:
    joined = F.concat(*[F.coalesce(c, F.lit("")) for c in (day_text, company, product)])
    return F.concat(F.lit("WEB-"), F.substring(F.regexp_replace(joined, "[^a-zA-Z0-9]+", ""), 1, 40))


def _body_rows(area: Column) -> Column:
    return _all(F.array_join(_all(area, _BODY), " "), _BODY_ROWS)


def _own_markup(piece: Column) -> Column:
    """A list row up to its closing tag (all of it, if tags are left open)."""
    def step(held: Column, part: Column) -> Column:
        depth = held["depth"] + part.rlike(_ROW_OPEN).cast("int") - part.rlike(_ROW_CLOSE).cast("int")
        return F.when(held["depth"] <= 0, held).otherwise(F.struct(depth.alias("depth"), F.concat(held["text"], part).alias("text")))

    start = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))
    return F.aggregate(F.split(piece, _ROW_EDGE), start, step, lambda held: held["text"])


def _href(link: Column) -> Column:
    """The one group with text; the others are empty."""
    return once(link, lambda a: F.coalesce(*[blank_to_null(_first(a, _HREF, group)) for group in (1, 2)], _first(a, _HREF, 3)))


def alert_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page columns without html, position, row markup) of the layout the page uses."""
    page = F.col(html)
    table_rows = _body_rows(F.array_join(_all(page, _TABLE4), " "))
    pieces = F.split(_first(page, _LIST_AREA, 0), _LIST_ROW)
    list_rows = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _own_markup)
    main_rows = _body_rows(_first(page, _MAIN, 0))
    listed = once(list_rows, lambda rows: F.when(F.size(rows) > 0, rows).otherwise(main_rows))
    rows = once(table_rows, lambda rows: F.when(F.size(rows) > 0, rows).otherwise(listed))
    keep = [c for c in pages.columns if c != html]
    # an inner explode would bring a filter on the size of the rows, which finds them again
    return pages.select(*keep, F.posexplode_outer(rows).alias("position", "row_html")).where(F.col("position").isNotNull())


def parse_alerts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Alerts of every page in the web-entry columns; list rows without a title link are dropped."""
    keep = [c for c in pages.columns if c != html]
    row = F.col("row_html")
    is_table = F.col("_table")
    fielded = alert_rows(pages, html).withColumn("_cells", settled(_all(row, _CELL, 1))).withColumn(
        "_table", F.size("_cells") >= 3).withColumn("_title_link", settled(F.when(~is_table, _first(row, _TITLE))))

    def text_of(n: int, mark: Column, missing: Column | None = None) -> Column:
        """Text of a table row's cell or of a list row's mark."""
        text = markup_text(F.when(is_table, F.get("_cells", F.lit(n))).otherwise(mark))
        return once(text, lambda t: F.when(is_table, F.coalesce(t, F.lit(""))).otherwise(t if missing is None else F.coalesce(t, missing)))

    date_mark = F.coalesce(blank_to_null(_first(row, _DATE_FIELD, 2)), _first(row, _TIME))
    company_mark = blank_to_null(_first(row, _COMPANY_FIELD, 2))
    title = F.col("_title_link")
    link = F.when(is_table, _first(F.get("_cells", F.lit(1)), _ANCHOR)).otherwise(F.col("_title_link"))
    parts = fielded.where(is_table | (F.col("_title_link") != "")).select(
        *keep, "position", row.alias("raw_html"), is_table.alias("_table"),
        text_of(0, date_mark).alias("_day"), text_of(1, title).alias("_product"), text_of(2, title).alias("_reason"),
        text_of(3, company_mark, F.lit(NO_COMPANY)).alias("_company"),
        once(_href(link), lambda url: F.when(is_table, blank_to_null(url)).otherwise(url)).alias("detail_url"))
    day = parse_page_date(F.col("_day"))
    filled = F.col("_table")
    return parts.select(
        *keep, "position",
        pseudo_id(F.col("_day"), F.col("_company"), F.col("_product")).alias("recall_number"),
        F.lit(R.SOURCE_WEB).alias("source"),
        F.when(filled, infer_product_type(F.col("_reason"), F.col("_product"))).otherwise(
            infer_product_type(F.col("_product"), F.lit(""))).alias("product_type"),
        F.when(filled, F.coalesce(blank_to_null(F.col("_company")), F.lit(NO_COMPANY)))
        .otherwise(F.col("_company")).alias("recalling_firm"),
        F.when(filled, F.coalesce(blank_to_null(F.col("_reason")), F.lit(NO_REASON)))
        .otherwise(F.col("_reason")).alias("reason_for_recall"),
        F.col("_product").alias("product_description"),
        day.alias("report_date"), day.alias("recall_initiation_date"), "detail_url", "raw_html")
