"""Put part rows (pages, sheet cells, paragraphs) together to one text per document.

A document's text is one value, bounded by the size gate on its source file. The parts
are combined in two steps - runs of neighbouring parts first, then the runs of a
document - so that sorting and joining a document with very many parts is shared by many
tasks, and the last step handles a few long strings instead of all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.functions.text import strip

RUN_LENGTH = 1000


def not_blank(text: Column | str) -> Column:
    return F.length(strip(text)) > 0


def _joined(order: str, text: str, separator: str) -> Column:
    """Aggregate: the texts of a group in ascending order, joined."""
    return F.array_join(F.sort_array(F.collect_list(F.struct(order, text))).getField(text), separator)


def ordered_join(parts: DataFrame, keys: list[str], position: str, text: str, separator: str,
                 output: str = "content", run_length: int = RUN_LENGTH) -> DataFrame:
    """Join ``text`` by ascending ``position`` within ``keys``."""
    runs = (
        parts.withColumn("_run", F.floor(F.col(position) / run_length))
        .groupBy(*keys, "_run").agg(_joined(position, text, separator).alias(text))
    )
    return runs.groupBy(*keys).agg(_joined("_run", text, separator).alias(output))


def assemble_pages(pages: DataFrame, doc: str = "doc", page: str = "page", text: str = "text") -> DataFrame:
    """(doc, page, text) rows to ``[Page n]`` blocks with a blank line between; blank pages are
    dropped and the others keep their number."""
    marked = pages.filter(not_blank(text)).withColumn(
        text, F.concat(F.lit("[Page "), F.col(page).cast("string"), F.lit("]\n"), F.col(text)))
    return ordered_join(marked, [doc], page, text, "\n\n")


def assemble_sheets(cells: DataFrame, doc: str = "doc", sheet: str = "sheet", title: str = "title",
                    row: str = "row", column: str = "column", value: str = "value",
                    run_length: int = RUN_LENGTH) -> DataFrame:
    """(doc, sheet number, title, row, column, value) rows to text: a header per sheet, then one
    line per row with its non-null cells; a row without values gives no line.

    Two groupings, each combined before its shuffle: cells to runs of rows, whose title goes with them, and runs to
    documents. In a document's sorted parts the headers of a sheet come first and the least one of them is kept.
    """
    cell = F.struct(F.col(row).alias("row"), F.col(column).alias("column"), F.col(value).alias("value"))
    runs = cells.withColumn("_run", F.floor(F.col(row) / run_length)).groupBy(doc, sheet, "_run").agg(
        F.sort_array(F.collect_list(F.when(F.col(value).isNotNull(), cell))).alias("_cells"), F.min(title).alias("_title"))

    def placed(x: Column, i: Column) -> Column:
        same = F.get("_cells", i - 1)["row"].eqNullSafe(x["row"])
        return F.concat(F.when(i == 0, "").when(same, " | ").otherwise("\n"), x["value"])

    runs = runs.withColumn("_text", F.when(F.size("_cells") > 0, F.array_join(F.transform("_cells", placed), "")))

    def part(kind: int, text: Column, title: Column, run: Column) -> Column:
        return F.collect_list(F.when(text.isNotNull(), F.struct(
            F.col(sheet).alias("sheet"), F.lit(kind).alias("kind"), title.alias("title"), run.alias("run"), text.alias("text"))))

    header = F.concat(F.lit("[Sheet: "), F.col("_title"), F.lit("]"))
    parts = F.concat(part(0, header, F.col("_title"), F.lit(None).cast("bigint")),
                     part(1, F.col("_text"), F.lit(None).cast("string"), F.col("_run")))

    def kept(x: Column, i: Column) -> Column:
        return F.when((x["kind"] == 1) | (i == 0) | ~F.get("_parts", i - 1)["sheet"].eqNullSafe(x["sheet"]), x["text"])

    return runs.groupBy(doc).agg(F.sort_array(parts).alias("_parts")).select(
        doc, F.array_join(F.transform("_parts", kept), "\n").alias("content"))


def assemble_paragraphs(parts: DataFrame, doc: str = "doc", kind: str = "kind", position: str = "position",
                        text: str = "text", paragraph: str = "paragraph") -> DataFrame:
    """Non-blank paragraphs in order, then all table rows in order."""
    is_paragraph = F.col(kind) == paragraph
    kept = parts.filter(~is_paragraph | not_blank(text))
    sections = ordered_join(
        kept.withColumn("_section", F.when(is_paragraph, 0).otherwise(1)),
        [doc, "_section"], position, text, "\n", "_text")
    return ordered_join(sections, [doc], "_section", "_text", "\n")


def part_counts(parts: DataFrame, doc: str, counted: dict[str, Column], names: str | None = None) -> DataFrame:
    """Counts of parts per document: each entry of ``counted`` is a condition; with ``names``
    also the sorted list of distinct part names."""
    out = [F.count_if(condition).cast("int").alias(label) for label, condition in counted.items()]
    if names:
        out.append(F.sort_array(F.collect_set(names)).alias("names"))
    return parts.groupBy(doc).agg(*out)
