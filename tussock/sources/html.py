"""HTML report pages -> rows.

Split of work:

* Python (``mapInPandas``, stdlib ``html.parser``) only tokenises each page
  into a flat, ordered list of elements: headings, text blocks or table rows
  with their cell texts. This is the one piece Spark's built-ins cannot do
  faithfully (entity decoding, nested inline tags, CDATA in scripts).
  The tokeniser also carries the last heading seen forward: a page is
  streamed in document order inside one task anyway, so doing it there avoids
  a shuffle of every extracted element that a window over (page, position)
  would need.
* Spark does the rest: row filters, positional cell picks and numeric parsing
  are built-in expressions.

Pages are independent, so the whole job is a narrow (map-only) stage: no
shuffle of HTML or of extracted rows. ``with_current_heading`` keeps the
window form for element tables that did not come from the tokeniser.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tussock.functions.cleaning import parse_money, parse_percent
from tussock.operators.windows import forward_fill

# The tokeniser travels to the tasks by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- Fixed values (report layout and junk-row names) ---
REPORT_HEADING_TAG = "h3"
MIN_CELLS = 4
JUNK_SUBURB_NAMES = ["suburb", "area", ""]
# --- end of fixed values ---

# An open text block (e.g. an unclosed <p>) ends where HTML would close it
# implicitly: at the start of another block or heading, or at the start or end
# of an enclosing block container.
BLOCK_BOUNDARY_START = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "div", "article", "section", "footer",
                        "header", "nav", "ul", "ol", "table", "main", "aside"}
OUTPUT_CHUNK_ROWS = 20_000

BLOCK_BOUNDARY_END = {"div", "article", "section", "footer", "header", "nav", "ul", "ol", "table", "main",
                      "aside", "body", "html"}

ELEMENT_FIELDS = [
    T.StructField("pos", T.IntegerType(), False),
    T.StructField("heading", T.StringType(), True),
    T.StructField("kind", T.StringType(), False),
    T.StructField("table_no", T.IntegerType(), True),
    T.StructField("row_no", T.IntegerType(), True),
    T.StructField("text", T.StringType(), True),
    T.StructField("cells", T.ArrayType(T.StringType()), True),
]


def _strip_join(parts: list[str]) -> str:
    """Text of an element as ``get_text(strip=True)``: every text piece
    stripped, empty pieces dropped, the rest concatenated."""
    return "".join(s for s in (p.strip() for p in parts) if s)


class _Tokeniser(HTMLParser):
    """Ordered headings and blocks (or table rows) of one document.

    A table's rows are all rows inside it and a row's cells all cells inside it, those of
    nested tables included; a nested table is a table of its own as well. A table stands
    at its start, under the heading last seen there.
    """

    def __init__(self, heading_tag: str, block_tag: str | None):
        super().__init__(convert_charrefs=True)
        self.heading_tag, self.block_tag = heading_tag, block_tag
        self.found: list[tuple] = []        # (kind, text or rows), in document order
        self.heading: list[str] | None = None
        self.block: list[str] | None = None
        self.tables: list[list] = []        # open tables, outermost first
        self.rows: list[tuple] = []         # open (table, row)
        self.cells: list[tuple] = []        # open (row, cell)

    def _close_block(self):
        if self.block is not None:
            self.found.append(("block", _strip_join(self.block)))
            self.block = None

    def _close_row(self):
        _, row = self.rows.pop()
        while self.cells and self.cells[-1][0] is row:
            self.cells.pop()

    def handle_starttag(self, tag, attrs):
        if self.block_tag is not None and (tag in BLOCK_BOUNDARY_START or tag in (self.block_tag, self.heading_tag)):
            self._close_block()
        if tag == self.heading_tag:
            self.heading = []
        elif self.block_tag is not None and tag == self.block_tag:
            self.block = []
        elif self.block_tag is None:
            if tag == "table":
                self.tables.append([])
                self.found.append(("table", self.tables[-1]))
            elif tag == "tr" and self.tables:
                if self.rows and self.rows[-1][0] is self.tables[-1]:
                    self._close_row()
                self.rows.append((self.tables[-1], []))
                for table in self.tables:
                    table.append(self.rows[-1][1])
            elif tag == "td" and self.rows:
                if self.cells and self.cells[-1][0] is self.rows[-1][1]:
                    self.cells.pop()
                self.cells.append((self.rows[-1][1], []))
                for _, row in self.rows:
                    row.append(self.cells[-1][1])

    def handle_endtag(self, tag):
        if tag == self.heading_tag and self.heading is not None:
            self.found.append(("heading", _strip_join(self.heading)))
            self.heading = None
        elif self.block_tag is not None and (tag == self.block_tag or tag in BLOCK_BOUNDARY_END):
            self._close_block()
        elif self.block_tag is None and self.tables:
            if tag == "td" and self.rows and self.cells and self.cells[-1][0] is self.rows[-1][1]:
                self.cells.pop()
            elif tag in ("tr", "table"):
                if self.rows and self.rows[-1][0] is self.tables[-1]:
                    self._close_row()
                if tag == "table":
                    self.tables.pop()

    def handle_data(self, data):
        for buf in (self.heading, self.block, *(cell for _, cell in self.cells)):
            if buf is not None:
                buf.append(data)

    def finish(self) -> list[tuple]:
        self.close()
        if self.block_tag is not None:
            self._close_block()
        out, current, table_no = [], None, -1
        for kind, what in self.found:
            if kind == "table":
                table_no += 1
                for row_no, row in enumerate(what):
                    out.append((len(out), current, "row", table_no, row_no, None, [_strip_join(c) for c in row]))
            else:
                current = what if kind == "heading" else current
                out.append((len(out), current, kind, None, None, what, None))
        return out


def tokenise(html: str | None, heading_tag: str, block_tag: str | None) -> list[tuple]:
    if not html:
        return []
    t = _Tokeniser(heading_tag, block_tag)
    t.feed(html)
    return t.finish()


def page_elements(pages: DataFrame, key_cols: list[str], html_col: str = "html",
                  heading_tag: str = REPORT_HEADING_TAG, block_tag: str | None = None) -> DataFrame:
    """One row per element (heading / block / table row) with its position in
    the page, the last heading seen at that point (``heading``), and the page
    key columns. ``block_tag=None`` = table mode."""
    key_fields = [f for f in pages.schema.fields if f.name in key_cols]
    schema = T.StructType(key_fields + ELEMENT_FIELDS)
    names = [f.name for f in schema.fields]

    def run(batches):
        # Emit in bounded chunks: a batch of large pages can expand to many
        # elements, and holding them all would grow the worker's memory.
        for pdf in batches:
            rows = []
            for rec in pdf.itertuples(index=False):
                d = rec._asdict()
                keys = [d[k] for k in key_cols]
                for el in tokenise(d[html_col], heading_tag, block_tag):
                    rows.append((*keys, *el))
                if len(rows) >= OUTPUT_CHUNK_ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names)

    return pages.select(*key_cols, html_col).mapInPandas(run, schema)


def with_current_heading(elements: DataFrame, page_key: str) -> DataFrame:
    """Window form of the heading carry: last heading text at or before each
    element in (page, pos) order. Equals the tokeniser's ``heading`` column."""
    h = elements.withColumn("_h", F.when(F.col("kind") == "heading", F.col("text")))
    return forward_fill(h.drop("heading"), "_h", page_key, "pos", "heading").drop("_h")


def report_rows(pages: DataFrame, page_key: str, carry: list[str] | None = None,
                heading_tag: str = REPORT_HEADING_TAG) -> DataFrame:
    """Suburb price-report tables -> (carry..., district, suburb, price, rent, yield).

    Rows belong to the last heading seen; a table before any (non-empty) heading
    yields nothing; the first row of every table is skipped; rows need at least
    four cells; header-like suburb names are skipped.
    """
    keys = [page_key] + (carry or [])
    el = page_elements(pages, keys, heading_tag=heading_tag, block_tag=None)
    rows = el.filter(
        (F.col("kind") == "row") & F.col("heading").isNotNull() & (F.col("heading") != "")
        & (F.col("row_no") >= 1) & (F.size("cells") >= MIN_CELLS)
    )
    suburb = F.element_at("cells", 1)
    rows = rows.filter(~F.lower(suburb).isin(JUNK_SUBURB_NAMES))
    return rows.select(
        *keys,
        F.col("heading").alias("district"),
        suburb.alias("suburb"),
        parse_money(F.element_at("cells", 2)).alias("avg_sale_price"),
        parse_money(F.element_at("cells", 3)).alias("avg_weekly_rent"),
        parse_percent(F.element_at("cells", 4)).alias("gross_yield_pct"),
    )


def page_rejects(pages: DataFrame, page_key: str, status_col: str = "status", html_col: str = "html") -> DataFrame:
    """(key, reason) of the pages that give no row: a status other than 200, no table, or
    tables without a usable row."""
    told = triage(pages, status_col, html_col)
    ok = told.filter(F.col("reason") == "ok")
    used = report_rows(ok, page_key).select(F.col(page_key).alias("_used")).distinct()
    empty = ok.select(page_key).join(used, F.col(page_key) == F.col("_used"), "left_anti")
    return (told.filter(F.col("reason") != "ok").select(page_key, "reason")
            .unionByName(empty.select(page_key, F.lit("no_rows").alias("reason"))))


def heading_blocks(pages: DataFrame, page_key: str, heading_tag: str, block_tag: str,
                   carry: list[str] | None = None) -> DataFrame:
    """Text blocks with the heading they fall under; blocks before any heading are dropped."""
    keys = [page_key] + (carry or [])
    el = page_elements(pages, keys, heading_tag=heading_tag, block_tag=block_tag)
    return el.filter((F.col("kind") == "block") & F.col("heading").isNotNull() & (F.col("heading") != "")).select(
        *keys, "heading", F.col("pos").alias("block_pos"), "text")


def triage(pages: DataFrame, status_col: str = "status", html_col: str = "html", content_tag: str = "table") -> DataFrame:
    """Response triage: non-200 -> 'http_<status>', no content tag -> 'no_content', else 'ok'."""
    has_tag = F.coalesce(F.col(html_col).rlike(f"(?i)<{content_tag}[\\s>]"), F.lit(False))
    reason = (F.when(F.col(status_col) != 200, F.concat(F.lit("http_"), F.col(status_col).cast("string")))
              .when(~has_tag, F.lit("no_content")).otherwise(F.lit("ok")))
    return pages.withColumn("reason", reason)
