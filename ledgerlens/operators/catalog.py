"""Catalog snapshots, key and reference lists, snapshot differences and constraint tests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import ordered
from ledgerlens.session import cut_lineage, spread

RELATION = ("table_schema", "table_name")


def all_relations(tables: DataFrame, matviews: DataFrame) -> DataFrame:
    """Tables and views with their type named, then materialised views, nothing removed; a field
    the second source lacks is empty."""
    kind = F.when(F.col("table_type") == "VIEW", "view").otherwise("table")
    named = tables.withColumn("type", kind).drop("table_type")
    return named.unionByName(matviews.withColumn("type", F.lit("materialized_view")), allowMissingColumns=True)


def index_columns(indexdef: str = "indexdef", indexname: str = "indexname") -> dict[str, Column]:
    """Uniqueness and member columns of an index, from its definition text."""
    upper = F.upper(indexdef)
    listed = F.regexp_extract(indexdef, r"\((.*)\)$", 1)
    members = F.transform(F.split(listed, ","), lambda c: F.replace(F.trim(c), F.lit('"'), F.lit("")))
    return {
        "is_unique": upper.contains("UNIQUE"),
        "is_primary": upper.contains("PRIMARY KEY") | F.endswith(indexname, F.lit("_pkey")),
        "columns": F.when(F.col(indexdef).rlike(r"\((.*)\)$"), members).otherwise(F.array().cast("array<string>")),
    }


#: children of one parent that go into one array
PART_ROWS = 100_000


def _arrays(child: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, part_rows: int) -> DataFrame:
    """Ordered arrays per ``keys`` and ``part``: the children are numbered along ``columns`` and cut every ``part_rows``,
    so the parts of a parent, one after the other, are its ordered list. The ranges they are numbered in run across parents, so no
    parent is one task."""
    ranges = max(8, int(child.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # equal children are one row with their number, as any order among them gives the same list
    alike = child.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("_copies"))
    alike = cut_lineage(alike.repartitionByRange(ranges, *keys, *columns).withColumn("_range", F.spark_partition_id()), "children")
    placed = ordered.running(alike, list(keys), "_range", list(columns), F.col("_copies"), "sum", "_upto")
    first, last = F.floor((F.col("_upto") - F.col("_copies")) / part_rows), F.floor((F.col("_upto") - 1) / part_rows)
    pieces = placed.withColumn("part", F.explode(F.sequence(first, last))).withColumn(
        "_copies", F.least("_upto", (F.col("part") + 1) * part_rows) - F.greatest(F.col("_upto") - F.col("_copies"), F.col("part") * part_rows)
    )
    child_row = F.struct(*columns)
    listed = F.flatten(F.array_sort(F.collect_list(F.struct(child_row.alias("child"), F.array_repeat(child_row, F.col("_copies").cast("int")).alias("rows"))))["rows"])
    return pieces.groupBy(*keys, "part").agg(listed.alias(name))


def _listed(child: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, part_rows: int, large: DataFrame | None) -> DataFrame:
    """Ordered arrays per ``keys`` and ``part``. Children of ``large`` parents are numbered in ranges; the other parents' arrays
    are part 0 by the same rule, and need no numbers."""
    few = child if large is None else child.join(large, list(keys), "left_anti")
    whole = few.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name)).withColumn("part", F.lit(0).cast("bigint"))
    if large is None:
        return whole
    return whole.unionByName(_arrays(child.join(large, list(keys), "left_semi"), keys, columns, name, part_rows))


def nest(
    parents: DataFrame, children: Mapping[str, tuple[DataFrame, Sequence[str]]], keys: Sequence[str] = RELATION, part_rows: int = PART_ROWS
) -> DataFrame:
    """Attach each child table to its parent as an ordered array named by the mapping's key.

    ``children[name]`` is a frame and the columns of one element, ordering columns first. A child
    without a parent is dropped, a parent without children gets an empty array.

    One array is one value in one task, so it is bounded: the ordered children of a kind are cut
    every ``part_rows``, and a parent comes as the rows ``part`` 0, 1, ...; its arrays, one after the other
    by ``part``, are the ordered lists. A parent with no more children than that is one row, by the same rule.
    """
    # parents with more children than one array takes: fewer than there are arrays to fill
    sizes = None
    for name, (child, _) in children.items():
        own = child.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_rows).select(F.lit(name).alias("_kind"), *keys, "_n")
        sizes = own if sizes is None else sizes.unionByName(own)
    large = cut_lineage(sizes, "large") if sizes is not None else None
    df = parents.withColumn("part", F.lit(0).cast("bigint"))
    split = large is not None and not large.isEmpty()
    if split:
        beyond = large.select(*keys, F.explode(F.sequence(F.lit(1).cast("bigint"), F.floor((F.col("_n") - 1) / part_rows))).alias("part")).distinct()
        df = df.unionByName(parents.join(beyond, list(keys)).select(*parents.columns, "part"))
    for name, (child, columns) in children.items():
        many = large.where(F.col("_kind") == name).select(*keys) if split else None
        grouped = _listed(child, keys, columns, name, part_rows, many)
        kind = grouped.schema[name].dataType
        df = df.join(grouped, [*keys, "part"], "left").withColumn(name, F.coalesce(name, F.array().cast(kind)))
    return df


def assemble_snapshot(
    relations: DataFrame, columns: DataFrame, indexes: DataFrame | None = None, checks: DataFrame | None = None,
    triggers: DataFrame | None = None,
) -> DataFrame:
    """One row per relation with its columns by position and indexes, checks and triggers by name."""
    children = {"columns": (columns, [c for c in ("ordinal", "column_name", "data_type", "is_nullable", "column_default") if c in columns.columns])}
    if indexes is not None:
        parsed = indexes.withColumns(index_columns())
        children["indexes"] = (parsed, ["indexname", "columns", "is_unique", "is_primary", "indexdef"])
    if checks is not None:
        children["checks"] = (checks, ["constraint_name", "check_clause"])
    if triggers is not None:
        children["triggers"] = (triggers, ["trigger_name", "event", "timing", "action_statement"])
    return nest(relations, children)


def snapshot_size(relations: DataFrame) -> DataFrame:
    """Relation count and the sorted schema list."""
    return relations.agg(
        F.count(F.lit(1)).alias("relations"), F.array_sort(F.collect_set("table_schema")).alias("schemas")
    )


def key_columns(constraints: DataFrame, usage: DataFrame, tasks: int | None = None) -> DataFrame:
    """Members of every PRIMARY KEY and UNIQUE constraint in key order, as an array (``members``) and a comma list (``columns``).

    ``tasks`` here and below: the partitions that large inputs are dealt to (``session.join_tasks``)."""
    wanted = constraints.where(F.col("constraint_type").isin("PRIMARY KEY", "UNIQUE"))
    members_of = spread(usage.select("table_schema", "constraint_name", "column_name", "ordinal_position"), tasks, "table_schema", "constraint_name")
    joined = spread(wanted, tasks, "table_schema", "constraint_name").join(members_of, ["table_schema", "constraint_name"])
    members = F.transform(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name"))), lambda m: m["column_name"])
    return joined.groupBy("table_schema", "table_name", "constraint_name", "constraint_type").agg(
        members.alias("members"), F.array_join(members, ",").alias("columns")
    )


def key_flags(columns: DataFrame, keys: DataFrame, tasks: int | None = None) -> DataFrame:
    """Mark columns that belong to a key; every member of a multi-column UNIQUE is marked."""
    column = ["table_schema", "table_name", "column_name"]
    listed = keys.select("table_schema", "table_name", "constraint_type", F.explode("members").alias("column_name"))
    members = spread(listed, tasks, *column).groupBy(*column).agg(
        F.bool_or(F.col("constraint_type") == "PRIMARY KEY").alias("is_primary_key"),
        F.bool_or(F.col("constraint_type") == "UNIQUE").alias("is_unique"),
    )
    marked = spread(columns, tasks, *column).join(members, column, "left")
    return marked.fillna(False, ["is_primary_key", "is_unique"])


def foreign_keys(constraints: DataFrame, usage: DataFrame, references: DataFrame, targets: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per foreign-key column and the column it refers to.

    Constraints are matched on schema *and* name, and columns of a composite key are paired by
    position, so a name used in two schemas does not fan out.
    """
    fk = constraints.where("constraint_type = 'FOREIGN KEY'").select("table_schema", "table_name", "constraint_name")
    target = targets.select(
        F.col("table_schema").alias("unique_constraint_schema"), F.col("constraint_name").alias("unique_constraint_name"),
        F.col("table_schema").alias("references_schema"), F.col("table_name").alias("references_table"),
        F.col("column_name").alias("references_column"), "ordinal_position",
    )
    own, referred = ["table_schema", "constraint_name"], ["unique_constraint_schema", "unique_constraint_name", "ordinal_position"]
    members = spread(usage.select(*own, "column_name", "ordinal_position"), tasks, *own)
    pairs = spread(fk, tasks, *own).join(members, own).join(spread(references, tasks, *own), own)
    return (
        spread(pairs, tasks, *referred)
        .join(spread(target, tasks, *referred), referred)
        .select(
            "table_schema", "table_name", "constraint_name", "column_name", "references_schema", "references_table",
            "references_column", "on_delete", "on_update",
        )
    )


def partition_children(inherits: DataFrame, classes: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Parent relations with the list of their partitions and bounds, in parts like :func:`nest`."""
    parent = classes.select(F.col("oid").alias("parent_oid"), F.col("schema").alias("parent_schema"), F.col("name").alias("parent_table"))
    child = classes.select(F.col("oid").alias("child_oid"), F.col("name").alias("child_table"), "bound")
    pairs = inherits.join(parent, "parent_oid").join(child, "child_oid").where(~F.col("parent_schema").like("pg_%"))
    pairs = pairs.withColumn("bound", F.coalesce("bound", F.lit("")))
    keys = ["parent_schema", "parent_table"]
    large = cut_lineage(pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > part_rows).select(*keys), "large")
    return _listed(pairs, keys, ["child_table", "bound"], "partitions", part_rows, None if large.isEmpty() else large)


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``added``, ``removed``, ``changed`` or ``same`` for every key of two snapshots. Settings are
    compared as values, null-safe, so two different rows never look equal."""
    setting = F.struct(*columns)
    a = old.select(*key, setting.alias("_old"))
    b = new.select(*key, setting.alias("_new"))
    state = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") != F.col("_new"), "changed")
        .otherwise("same")
    )
    return a.join(b, list(key), "full_outer").select(*key, state.alias("state"))


def constraint_check(
    df: DataFrame, kind: str, columns: Sequence[str] = (), reference: tuple[DataFrame, Sequence[str]] | None = None,
    check: Column | None = None,
) -> DataFrame:
    """Rows (for ``unique``: key groups with their size) that violate a constraint, with its code.

    ``unique`` 23505, ``foreign_key`` 23503, ``not_null`` 23502, ``check`` 23514. As in SQL, a null
    in a unique or foreign key satisfies it, and so does a check that is null.
    """
    present = None
    for c in columns:
        present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
    if kind == "unique":
        groups = df.where(present).groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
        return groups.where("copies > 1").withColumn("code", F.lit("23505"))
    if kind == "foreign_key":
        parent, names = reference
        keys = parent.select(*[F.col(p).alias(c) for p, c in zip(names, columns)]).distinct()
        return df.where(present).join(keys, list(columns), "left_anti").withColumn("code", F.lit("23503"))
    if kind == "not_null":
        return df.where(~present).withColumn("code", F.lit("23502"))
    if kind == "check":
        return df.where(~F.coalesce(check, F.lit(True))).withColumn("code", F.lit("23514"))
    raise ValueError(f"unknown constraint kind {kind!r}")
