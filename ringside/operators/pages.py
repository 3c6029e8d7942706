"""Structure of stored HTML pages: patterns over the whole text, and for tables, which nest, its stream of tags."""

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Status letters a page may show.
STATUSES = ["w", "l", "d", "nc"]

OPEN_TABLE = r"(?i)<table\b[^>]*>"
HAS_CLASS = r"(?i)\sclass\s*="
LINK = r"(?is)<a\b([^>]*)>(.*?)</a>"
HEADING = r"(?is)<h[23]\b[^>]*>(.*?)</h[23]>"


def _all(html: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(group))


def _text(fragment: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(fragment, r"<[^>]*>", " "), r"\s+", " "))


def table_profile(pages: DataFrame) -> DataFrame:
    """Tables per page, those without a class, rows, header and data cells."""
    html = F.col("html")
    tables = _all(html, OPEN_TABLE)
    return pages.select(
        "page_id",
        F.size(tables).alias("n_tables"),
        F.size(F.filter(tables, lambda t: ~t.rlike(HAS_CLASS))).alias("n_classless_tables"),
        F.size(_all(html, r"(?i)<tr\b")).alias("n_rows"),
        F.size(_all(html, r"(?i)<th\b")).alias("n_header_cells"),
        F.size(_all(html, r"(?i)<td\b")).alias("n_data_cells"),
        F.size(_all(html, r"(?i)<section\b")).alias("n_sections"),
    )


# Elements without content, and elements whose text is no text of the page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style", "template"}


class _Tables(HTMLParser):
    """Rows of the tables without a class, from a stack of the elements that are open.

    An end tag closes the innermost open element of its name and all inside it; one that nothing matches is skipped. A
    row belongs to every table that is open around it, a cell to every row, a text to every cell. What is still open at
    the end of the page ends there.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, list | None]] = []
        self.tables, self.rows, self.text = 0, [], []

    def _held(self, kind: str) -> Iterator[list]:
        return (thing for name, thing in self.open if name == kind and thing is not None)

    def handle_starttag(self, tag, attrs):
        self._flush()
        classes = next((v for k, v in attrs if k == "class"), None)
        thing = None
        if tag == "table":
            if not (classes or "").strip():
                thing = [self.tables, 0]
            self.tables += 1
        elif tag == "tr":
            thing = [(classes or "").strip() or None, [], []]
            for table in self._held("table"):
                self.rows.append((table[0], table[1], thing))
                table[1] += 1
        elif tag in ("th", "td"):
            thing = []
            for row in self._held("tr"):
                row[1].append(tag)
                row[2].append(thing)
        if tag not in VOID:
            self.open.append((tag, thing))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        self.text.append(data)

    def handle_comment(self, data):
        self._flush()

    def _flush(self):
        text = "".join(self.text).strip()
        self.text = []
        if text and not any(name in HIDDEN for name, _ in self.open):
            for name, cell in self.open:
                if name in ("th", "td") and cell is not None:
                    cell.append(text)

    def found(self) -> list[tuple]:
        self._flush()
        return [(t, r, row[0], row[1], [" ".join(c) for c in row[2]]) for t, r, row in self.rows]


def rows_of_page(html: str | None) -> list[tuple]:
    """(table_no, row_no, row_class, tags, texts) of every row of every class-less table of one page, in order."""
    scan = _Tables()
    scan.feed(html or "")
    scan.close()
    return sorted(scan.found(), key=lambda r: r[:2])


def table_rows(pages: DataFrame) -> DataFrame:
    """Every row of every class-less table: its table's place among all of the page, its place, class and cell texts.

    Tables may nest: a row inside an inner table is one of the outer table too, and its text is part of the outer cell's.
    A null page has no rows.
    """
    def of(batches):
        names = ["table_no", "row_no", "row_class", "tags", "texts"]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string())]
        for batch in batches:
            found = [rows_of_page(h) for h in batch.column(1).to_pylist()]
            every = batch.column(0).take(pa.array([i for i, rows in enumerate(found) for _ in rows], pa.int64()))
            flat = list(zip(*(r for rows in found for r in rows))) or [[]] * 5
            yield pa.RecordBatch.from_arrays([every, *[pa.array(list(v), k) for v, k in zip(flat, kinds)]], ["page_id", *names])

    kind = dict(pages.dtypes)["page_id"]
    return pages.select("page_id", "html").mapInArrow(
        of, f"page_id {kind}, table_no int, row_no int, row_class string, tags array<string>, texts array<string>")


def links(pages: DataFrame) -> DataFrame:
    """Every link with its text, target and class."""
    each = pages.select("page_id", F.posexplode(_all(F.col("html"), LINK)).alias("link_no", "a"))
    head = F.regexp_extract("a", r"(?is)^<a\b([^>]*)>", 1)
    return each.select(
        "page_id",
        "link_no",
        _text(F.regexp_extract("a", LINK, 2)).alias("text"),
        F.nullif(F.regexp_extract(head, r"(?i)href\s*=\s*\"([^\"]*)\"", 1), F.lit("")).alias("href"),
        F.nullif(F.regexp_extract(head, r"(?i)class\s*=\s*\"([^\"]*)\"", 1), F.lit("")).alias("link_class"),
    )


def status_nodes(pages: DataFrame) -> DataFrame:
    """Text nodes that are exactly a status letter, counted per page and letter."""
    nodes = pages.select("page_id", F.explode(F.split("html", "<[^>]*>")).alias("node"))
    token = F.lower(F.trim("node"))
    return nodes.filter(token.isin(STATUSES)).groupBy("page_id", token.alias("status")).agg(
        F.count(F.lit(1)).alias("n")
    )


def headings(pages: DataFrame) -> DataFrame:
    each = pages.select("page_id", F.posexplode(_all(F.col("html"), HEADING, 1)).alias("heading_no", "h"))
    return each.select("page_id", "heading_no", _text(F.col("h")).alias("heading"))


def corner_checks(bouts: DataFrame) -> DataFrame:
    """Per bout: two distinct people, and exactly two valid statuses keyed by their URLs.

    ``bouts``: fight_url, name1, url1, name2, url2, result (map of URL to status).
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    valid = ["W", "L", "D", "NC"]
    parts = {"distinct_people": yes(
        (F.col("name1") != F.col("name2")) & (F.col("url1") != F.col("url2"))
        & (F.col("name1") != "") & (F.col("url1") != "") & (F.col("name2") != "") & (F.col("url2") != "")
    )}
    parts["two_results"] = yes(F.size("result") == 2)
    for s in (1, 2):
        parts[f"url{s}_in_results"] = yes(F.map_contains_key("result", F.coalesce(F.col(f"url{s}"), F.lit(""))))
        parts[f"status{s}_valid"] = yes(F.try_element_at(F.col("result"), F.col(f"url{s}")).isin(valid))
    rows = bouts.select("fight_url", *[v.alias(k) for k, v in parts.items()])
    results_ok = F.lit(True)
    for k in list(parts)[1:]:
        results_ok = results_ok & F.col(k)
    return rows.withColumn("results_ok", results_ok)


def corner_check_counts(checked: DataFrame) -> DataFrame:
    return checked.agg(
        F.count_if("distinct_people").alias("people_passed"),
        F.count_if(~F.col("distinct_people")).alias("people_failed"),
        F.count_if("results_ok").alias("results_passed"),
        F.count_if(~F.col("results_ok")).alias("results_failed"),
    )
