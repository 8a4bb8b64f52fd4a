"""Set-oriented operators over a ledger: trees, text, assets, inventories, coverage, integrity, tables, evidence, references."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docledger import ids
from docledger.lineage import cut

# trees and text


def descendants(nodes: DataFrame, roots: DataFrame, by: str = "doc") -> DataFrame:
    """root_seq and the rows of nodes below it. Both sides have by and seq; roots have subtree_end, the last place below them."""
    # each root names the places below it, so that the join is of equal places and no larger than its result
    inside = roots.where("subtree_end > seq").select(F.col(by).alias("_by"), F.col("seq").alias("root_seq"), F.explode(F.expr("sequence(cast(seq as bigint) + 1, cast(subtree_end as bigint))")).alias("_at"))
    return nodes.join(inside, (F.col(by) == F.col("_by")) & (F.col("seq") == F.col("_at"))).drop("_by", "_at")


def joined_text(rows: DataFrame, by: list[str], text: str = "text", order: str = "seq", into: str = "content") -> DataFrame:
    """The texts of each group, one after the other in order."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text])
    return rows.groupBy(*by).agg(F.array_join(parts, "").alias(into))


def with_sequence(rows: DataFrame, by: list[str], order: list[str], into: str = "seq") -> DataFrame:
    """Dense places from 0."""
    return rows.withColumn(into, (F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1).cast("long"))


def visible(kind: Column, text: Column, latex: Column, deleted: Column) -> Column:
    """What a node adds to the text of its block."""
    return (
        F.when((kind == "text_run") & ~F.coalesce(deleted, F.lit(False)), F.coalesce(text, F.lit("")))
        .when((kind == "equation") & (F.length(latex) > 0), F.concat(F.lit("<eq>"), latex, F.lit("</eq>")))
        .when(kind == "line_break", "\n")
        .when(kind == "tab", "\t")
    )


# assets, inventories, coverage


def assets(occurrences: DataFrame, data: str, name: str, part: str, order: str) -> DataFrame:
    """Content-addressed assets: asset_id, occurrences, the first name, and the parts they stand in, sorted."""
    keyed = occurrences.select(ids.asset_id(F.col(data)).alias("asset_id"), name, F.col(part).alias("_part"), order)
    return keyed.groupBy("asset_id").agg(F.count("*").alias("occurrences"), F.min_by(name, order).alias("original_name"), F.array_join(F.array_sort(F.collect_set("_part")), ",").alias("source_parts"))


#: Features that a coverage report reconciles.
RECONCILED = ("visible_text_nodes", "visible_text_chars", "image_blips", "tables", "equations", "hyperlinks", "field_hyperlinks", "charts", "textboxes", "structured_document_tags")


def coverage(counts: DataFrame, by: list[str]) -> DataFrame:
    """by, feature, source, extracted, diagnosed, silent, ratio from rows (by, feature, source, extracted, diagnosed)."""
    found = reconciled(F.col("source"), F.col("extracted"), F.col("diagnosed"))
    return counts.select(*by, "feature", "source", *[found[f].alias(f) for f in ("extracted", "diagnosed", "silent", "ratio")])


def reconciled(source: Column, extracted: Column, diagnosed: Column) -> Column:
    """struct(extracted, diagnosed, silent, ratio) of what was counted, extracted and diagnosed of a feature."""
    failed = F.greatest(F.lit(0).cast("long"), source - extracted)
    told = F.least(failed, diagnosed)
    shown = F.when(source > 0, F.least(extracted, source)).otherwise(extracted)
    ratio = F.when(source == 0, 1.0).otherwise(F.round(shown / source, 6))
    return F.struct(shown.cast("long").alias("extracted"), told.cast("long").alias("diagnosed"), (failed - told).cast("long").alias("silent"), ratio.alias("ratio"))


# checks


def duplicated(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def unresolved(refs: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    """References without a row that they refer to."""
    return refs.join(known.select(*key).distinct(), key, "left_anti")


def pairing(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str]) -> DataFrame:
    """Each key of either side and what is wrong with it: missing on a side, or standing there twice; ok else."""
    a = left.groupBy(key).agg(F.count("*").alias("a"))
    b = right.groupBy(key).agg(F.count("*").alias("b"))
    n, m = F.coalesce("a", F.lit(0)), F.coalesce("b", F.lit(0))
    verdict = F.when(n == 0, f"missing {names[0]}").when(m == 0, f"missing {names[1]}").when(n > 1, f"duplicate {names[0]}").when(m > 1, f"duplicate {names[1]}").otherwise("ok")
    return a.join(b, key, "full_outer").select(key, verdict.alias("verdict"))


def first_of(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_n = 1").drop("_n")


def integrity(nodes: DataFrame, by: str = "doc") -> DataFrame:
    """Per document: nodes, ids that repeat, parents that are missing, gaps in the sequence."""
    per = nodes.groupBy(by).agg(F.count("*").alias("n_nodes"), (F.count("node_id") - F.count_distinct("node_id")).alias("duplicate_ids"), (F.max("seq") - F.min("seq") + 1 - F.count_distinct("seq")).alias("gaps"))
    parents = nodes.where("parent_seq is not null").select(by, F.col("parent_seq").alias("seq"))
    orphans = parents.join(nodes.select(by, "seq").distinct(), [by, "seq"], "left_anti").groupBy(by).agg(F.count("*").alias("missing_parents"))
    return per.join(orphans, by, "left").withColumn("missing_parents", F.coalesce("missing_parents", F.lit(0).cast("long")))


# tables


def grid(cells: DataFrame, by: list[str]) -> DataFrame:
    """Per table: n_rows, n_columns, and whether every place of the grid is taken. cells: row, column, column_span, and declared, a table's own number of columns, if that is known."""
    reach = F.max(F.col("column") + F.col("column_span"))
    declared = F.max(F.when(F.col("declared") > 0, F.col("declared"))) if "declared" in cells.columns else F.lit(None)
    size = cells.groupBy(*by).agg(F.coalesce(declared, reach).cast("int").alias("n_columns"), F.count_distinct("row").alias("n_rows"))
    taken = cells.select(*by, "row", F.explode(F.when(F.col("column_span") > 0, F.sequence(F.col("column"), F.col("column") + F.col("column_span") - 1))).alias("at")).distinct()
    full = taken.join(size.select(*by, "n_columns"), by).where("at < n_columns").groupBy(*by).agg(F.count("*").alias("taken"))
    return size.join(full, by, "left").select(*by, "n_rows", "n_columns", (F.coalesce("taken", F.lit(0)) == F.col("n_rows") * F.col("n_columns")).alias("rectangular"))


def header_rows(cells: DataFrame, by: list[str]) -> DataFrame:
    """Rows that are headers: marked ones, else the first one if it holds no number and a later row does. cells: row, value, marked."""
    rows = cells.groupBy(*by, "row").agg(F.bool_or("marked").alias("marked"), F.count("value").alias("numbers"))
    w = Window.partitionBy(*by)
    rows = rows.withColumn("_any", F.bool_or("marked").over(w)).withColumn("_first", F.min("row").over(w)).withColumn("_all", F.sum("numbers").over(w))
    inferred = ~F.col("_any") & (F.col("row") == F.col("_first")) & (F.col("numbers") == 0) & (F.col("_all") > 0)
    return rows.where(F.col("marked") | inferred).select(*by, "row")


def chart_candidates(cells: DataFrame, by: list[str]) -> DataFrame:
    """Tables that can be drawn: category_column, categories and series (name=values, joined), from a full grid with one header row.

    cells: row, column, column_span, original, value, marked. The category column is the first whose cells all hold text;
    categories must differ; a series is any other column that holds numbers alone.
    """
    shape = grid(cells, by)
    heads = header_rows(cells, by)
    one = heads.groupBy(*by).agg(F.count("*").alias("n"), F.min("row").alias("header")).where("n = 1").select(*by, "header")
    good = cells.join(shape.where("rectangular and n_columns >= 2").select(*by, "n_columns"), by).join(one, by).where("column < n_columns")
    text = F.length(F.trim("original")) > 0
    single = F.col("column_span") == 1
    columns = good.groupBy(*by, "column").agg(
        F.max("n_columns").alias("n_columns"),
        F.max(F.when((F.col("row") == F.col("header")) & single & text, F.col("original"))).alias("name"),
        F.count_if(F.col("row") != F.col("header")).alias("n"),
        F.count_if((F.col("row") != F.col("header")) & single & F.col("value").isNull() & text).alias("texts"),
        F.count_if((F.col("row") != F.col("header")) & single & F.col("value").isNotNull()).alias("numbers"),
        F.count_distinct(F.when(F.col("row") != F.col("header"), F.col("original"))).alias("kinds"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("row") != F.col("header"), F.struct("row", "original")))), lambda x: x["original"]), ",").alias("cells"),
    )
    w = Window.partitionBy(*by)
    columns = columns.withColumn("category_column", F.min(F.when((F.col("texts") == F.col("n")) & (F.col("n") > 0), F.col("column"))).over(w)).withColumn("_named", F.count("name").over(w))
    series = F.when((F.col("column") != F.col("category_column")) & (F.col("numbers") == F.col("n")), F.struct("column", F.concat("name", F.lit("="), "cells").alias("s")))
    out = columns.where("_named = n_columns and category_column is not null").groupBy(*by, "category_column").agg(
        F.max(F.when(F.col("column") == F.col("category_column"), F.col("cells"))).alias("categories"),
        F.max(F.when(F.col("column") == F.col("category_column"), F.col("kinds") == F.col("n"))).alias("_differ"),
        F.array_join(F.transform(F.array_sort(F.collect_list(series)), lambda x: x["s"]), ";").alias("series"),
    )
    return out.where("_differ and series != ''").drop("_differ")


# evidence

#: Kinds of blocks that become evidence.
EVIDENCE_KINDS = ("text", "title", "caption", "list", "table", "image", "equation", "chart")


def evidence(blocks: DataFrame) -> DataFrame:
    """evidence_id beside the columns of blocks (doc, block_id, kind, sources: an array of node ids); other kinds are left out."""
    return blocks.where(F.col("kind").isin(*EVIDENCE_KINDS)).withColumn("evidence_id", ids.evidence_id(F.col("doc"), F.col("kind"), F.col("block_id"), "primary", F.col("sources")))


def chain(edges: DataFrame, key: str, above: str, values: list[str]) -> DataFrame:
    """key and, of each value, the nearest one that is not null on the way up, however far that is; what lies above a circle is nothing but the circle.

    Each round looks twice as far: a row takes what the row at its end has found and goes on from that row's end, so the number of rounds is the logarithm of
    the longest way. Each round is written to the shared folder. Keys are unique.
    """
    now = cut(edges.select(F.col(key).alias("_k"), F.col(above).alias("_up"), *values))
    open_ = F.col("_up").isNotNull() & reduce(lambda a, b: a | b, [F.col(v).isNull() for v in values])
    for _ in range(now.count().bit_length()):  # no way is longer than there are rows
        if now.where(open_).isEmpty():
            break
        further = now.select(F.col("_k").alias("_j"), F.col("_up").alias("_next"), *[F.col(v).alias(f"_{v}") for v in values])
        now = cut(now.join(further, now["_up"] == further["_j"], "left").select("_k", F.col("_next").alias("_up"), *[F.coalesce(v, f"_{v}").alias(v) for v in values]))
    return now.select(F.col("_k").alias(key), *values)
