"""Row-level update / delete / merge as pure DataFrame -> DataFrame transforms.

Null rules:
- UPDATE / DELETE act only where the predicate is TRUE; a NULL predicate leaves
  the row as it is (unlike ``filter(col != x)``, which drops NULLs).
- Every SET expression sees the *old* row (one projection, not chained
  ``withColumn``), so ``SET a = b, b = a`` swaps.
- MERGE: NULL keys never match; such source rows are inserted and such
  target rows kept.

Merge plan (no full outer join): ``target LEFT OUTER JOIN source`` gives the
kept and updated rows, ``source LEFT ANTI JOIN target`` the inserted ones. A hot
key (one key holding a large share of the target) sits on the streamed side of
both joins, where AQE can split skewed partitions; a full outer sort-merge join
would buffer all rows of that key from both sides in one task. When the source
is small AQE turns both joins into broadcast joins from measured sizes.

The "kind" variants tag each output row as keep / pre / post / insert / delete
so one pass can feed both a new snapshot and the change feed.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakeops.functions.columns import as_column, is_true

KIND = "__kind"
_PRESENT = "__src_present"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def column_name(key: str, names: Sequence[str]) -> str:
    """The column a SET or INSERT key names: as it is, behind a table alias (``t.c``), in backticks, or in
    another letter case where only one column fits."""
    bare = re.fullmatch(r"(?:(?:\w+|`[^`]+`)\.)?`([^`]+)`", key)
    spelled = [key, *([bare.group(1)] if bare else []), *([key.split(".", 1)[1]] if "." in key else [])]
    for one in spelled:
        if one in names:
            return one
    for one in spelled:
        fits = [n for n in names if n.casefold() == one.casefold()]
        if len(fits) == 1:
            return fits[0]
    return spelled[-1]


def _set_exprs(names: Sequence[str], set: Mapping[str, str | Column]) -> dict[str, Column]:
    exprs = {column_name(k, names): as_column(v) for k, v in set.items()}
    unknown = [k for k in exprs if k not in names]
    if unknown:
        raise ValueError(f"unknown columns in SET: {unknown}")
    return exprs


def update_rows(df: DataFrame, set: Mapping[str, str | Column], condition: str | Column | None = None) -> DataFrame:
    """UPDATE df SET ... WHERE condition, as one projection."""
    cond = is_true(condition) if condition is not None else F.lit(True)
    exprs = _set_exprs(df.columns, set)
    return df.select(
        *[
            (F.when(cond, exprs[n].cast(df.schema[n].dataType)).otherwise(_c(n)) if n in exprs else _c(n)).alias(n)
            for n in df.columns
        ]
    )


def update_kinds(df: DataFrame, set: Mapping[str, str | Column], condition: str | Column | None = None) -> DataFrame:
    """UPDATE with change rows: matched rows give a ``pre`` and a ``post`` row, others ``keep``."""
    cond = is_true(condition) if condition is not None else F.lit(True)
    names = df.columns
    exprs = _set_exprs(names, set)
    new = [(exprs[n].cast(df.schema[n].dataType) if n in exprs else _c(n)).alias(n) for n in names]
    old = [_c(n).alias(n) for n in names]
    pre = F.struct(*old, F.lit("pre").alias(KIND))
    post = F.struct(*new, F.lit("post").alias(KIND))
    keep = F.struct(*old, F.lit("keep").alias(KIND))
    return df.select(F.inline(F.when(cond, F.array(pre, post)).otherwise(F.array(keep))))


def delete_rows(df: DataFrame, condition: str | Column | None = None) -> DataFrame:
    """DELETE FROM df WHERE condition; rows whose condition is NULL stay."""
    if condition is None:
        return df.limit(0)
    return df.where(~is_true(condition))


def delete_kinds(df: DataFrame, condition: str | Column) -> DataFrame:
    cond = is_true(condition)
    return df.withColumn(KIND, F.when(cond, F.lit("delete")).otherwise(F.lit("keep")))


@dataclass
class MergePlan:
    target: DataFrame
    source: DataFrame
    cond: Column
    names: list[str]
    ta: str
    sa: str
    update: dict[str, Column] | None
    insert: dict[str, Column] | None
    keys: list[str] | None = None  # set when the condition is equality on named columns
    null_safe: bool = False  # named keys: NULL matches NULL

    def touched_files(self, file_col: str = "__file", row_col: str = "__row") -> DataFrame:
        """Files of ``target`` holding matched rows, with the largest number of source
        rows matching one target row of that file (``n`` > 1 = ambiguous merge).

        Named keys: source rows are counted per key first (partial aggregation
        collapses duplicate and hot keys), inner-joined to the target's keys and
        reduced per file; no per-row id is shuffled. A general condition: matched
        pairs are reduced per (file id, row index), with a 64-bit hash standing
        in for the file path so each pair shuffles 16 bytes, not a path.
        """
        t = self.target
        if self.keys is not None:
            own = [_c(k).alias(f"__k{i}") for i, k in enumerate(self.keys)]
            per_key = self.source.groupBy(*own).agg(F.count(F.lit(1)).alias("__n"))
            same = F.lit(True)
            for i, k in enumerate(self.keys):
                a, b = t[f"`{k}`"], per_key[f"__k{i}"]
                same = same & (a.eqNullSafe(b) if self.null_safe else a == b)
            matched = t.select(file_col, *[_c(k) for k in self.keys]).join(per_key, same, "inner")
            return matched.groupBy(file_col).agg(F.max("__n").alias("n"))
        pairs = t.alias(self.ta).join(self.source.alias(self.sa), self.cond, "inner").select(
            F.xxhash64(F.col(f"{self.ta}.{file_col}")).alias("__fid"),
            F.col(f"{self.ta}.{row_col}").alias("__row"),
        )
        per_file = (
            pairs.groupBy("__fid", "__row").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("__fid").agg(F.max("n").alias("n"))
        )
        # File names from the target's own metadata (one row per file after
        # partial aggregation), not from a second evaluation of the join.
        names = t.select(F.xxhash64(F.col(file_col)).alias("__fid"), F.col(file_col)).distinct()
        return per_file.join(names, "__fid").select(file_col, "n")

    def rows(self, target: DataFrame, with_kind: bool = False, emit_pre: bool = False) -> DataFrame:
        """Merged rows for ``target`` (all target rows that may match) plus inserts.

        Values are cast to the target column types, so a SET or INSERT expression
        can never change the schema.
        """
        ta, sa, names = self.ta, self.sa, self.names
        types = {n: target.schema[n].dataType for n in names}
        src = self.source.withColumn(_PRESENT, F.lit(True))
        joined = target.alias(ta).join(src.alias(sa), self.cond, "left")
        matched = F.col(f"{sa}.{_PRESENT}").isNotNull()
        old = [F.col(f"{ta}.`{n}`") for n in names]
        upd = self.update or {}
        new = [(upd[n].cast(types[n]) if n in upd else F.col(f"{ta}.`{n}`")) for n in names]
        if emit_pre and self.update is not None:
            pre = F.struct(*[c.alias(n) for c, n in zip(old, names)], F.lit("pre").alias(KIND))
            post = F.struct(*[c.alias(n) for c, n in zip(new, names)], F.lit("post").alias(KIND))
            keep = F.struct(*[c.alias(n) for c, n in zip(old, names)], F.lit("keep").alias(KIND))
            out = joined.select(F.inline(F.when(matched, F.array(pre, post)).otherwise(F.array(keep))))
        else:
            kind = F.when(matched & F.lit(self.update is not None), F.lit("post")).otherwise(F.lit("keep"))
            out = joined.select(
                *[F.when(matched, nv).otherwise(ov).alias(n) for n, nv, ov in zip(names, new, old)], kind.alias(KIND)
            )
        ins = self.inserts(target)
        if ins is not None:
            out = out.unionByName(ins)
        return out if with_kind else out.drop(KIND)

    def inserts(self, target: DataFrame) -> DataFrame | None:
        """Source rows without a match in ``target``, as target rows with their kind (None without an insert clause).
        Copies of a source row are all inserted."""
        if self.insert is None:
            return None
        types = {n: target.schema[n].dataType for n in self.names}
        rest = self.source.alias(self.sa).join(target.alias(self.ta), self.cond, "left_anti")
        return rest.select(
            *[(self.insert[n] if n in self.insert else F.lit(None)).cast(types[n]).alias(n) for n in self.names],
            F.lit("insert").alias(KIND),
        )


def merge_condition(condition: str | Column | Sequence[str], ta: str, sa: str, null_safe: bool = False) -> Column:
    """Join condition: key column names (equality), a SQL string over the aliases, or a Column."""
    if isinstance(condition, (list, tuple)):
        cond = F.lit(True)
        for k in condition:
            a, b = F.col(f"{ta}.`{k}`"), F.col(f"{sa}.`{k}`")
            cond = cond & (a.eqNullSafe(b) if null_safe else a == b)
        return cond
    return as_column(condition)


def equal_keys(condition: str | Column, ta: str, sa: str) -> list[str] | None:
    """Column names, if the condition is only ``ta.k = sa.k`` terms joined by AND (else None)."""
    side = r"(\w+)\.`?(\w+)`?"
    if isinstance(condition, str):
        text, term = condition, rf"{side}\s*=\s*{side}"
    else:  # a Column prints as and(=(t.k, s.k), ...)
        text, term = condition._jc.toString(), rf"=\({side}, {side}\)"
    found = re.findall(term, text)
    rest = re.sub(term, "", text)
    if not found or not re.fullmatch(r"(?i)(?:\band\b|[(),\s])*", rest):
        return None
    if any(a != b or {x, y} != {ta, sa} for x, a, y, b in found):
        return None
    return [a for _, a, _, _ in found]


def merge_plan(
    target: DataFrame,
    source: DataFrame,
    condition: str | Column | Sequence[str],
    ta: str,
    sa: str,
    names: Sequence[str],
    update_set: Mapping[str, str | Column] | None = None,
    update_all: bool = False,
    insert_values: Mapping[str, str | Column] | None = None,
    insert_all: bool = False,
    optional: Sequence[str] = (),
    null_safe: bool = False,
) -> MergePlan:
    """``optional``: target columns the source may lack for update-all / insert-all
    (generated columns, recomputed at write)."""
    names = list(names)
    update = None
    if update_all:
        update = {n: F.col(f"{sa}.`{n}`") for n in names if n in source.columns}
    elif update_set is not None:
        update = _set_exprs(names, update_set)
    insert = None
    if insert_all:
        missing = [n for n in names if n not in source.columns and n not in optional]
        if missing:
            raise ValueError(f"insert-all: source lacks {missing}")
        insert = {n: F.col(f"{sa}.`{n}`") for n in names if n in source.columns}
    elif insert_values is not None:
        insert = _set_exprs(names, insert_values)
    keys = list(condition) if isinstance(condition, (list, tuple)) else None
    return MergePlan(target, source, merge_condition(condition, ta, sa, null_safe), names, ta, sa, update, insert, keys, null_safe)


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    condition: str | Column | Sequence[str],
    target_alias: str = "t",
    source_alias: str = "s",
    update_set: Mapping[str, str | Column] | None = None,
    update_all: bool = False,
    insert_values: Mapping[str, str | Column] | None = None,
    insert_all: bool = False,
) -> DataFrame:
    """MERGE INTO target USING source ON condition (pure transform, no ambiguity check)."""
    plan = merge_plan(target, source, condition, target_alias, source_alias, target.columns,
                      update_set, update_all, insert_values, insert_all)
    return plan.rows(target)


def _common_type(spark, a, b):
    """The type both can be compared in: the one Spark's union finds (text stays text), else text."""
    if a == b:
        return a
    if StringType() in (a, b):
        return StringType()
    try:
        return spark.range(0).select(F.lit(None).cast(a).alias("c")).union(spark.range(0).select(F.lit(None).cast(b).alias("c"))).schema[0].dataType
    except Exception as e:  # noqa: BLE001  (an analysis error of the union)
        if "INCOMPATIBLE" not in str(e):
            raise
        return StringType()


def align_columns(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns of either, by name (the new one's order first): a column one lacks is NULL
    there, and types that differ become a common one."""
    names = [*new.columns, *[c for c in old.columns if c not in new.columns]]
    if names == old.columns and old.schema.simpleString() == new.schema.simpleString():
        return old, new
    cols: tuple[list, list] = ([], [])
    for n in names:
        found = [df.schema[n].dataType if n in df.columns else None for df in (old, new)]
        kind = found[0] or found[1] if None in found else _common_type(old.sparkSession, *found)
        for out, own in zip(cols, found):
            out.append((_c(n) if own is not None else F.lit(None)).cast(kind).alias(n))
    return old.select(*cols[0]), new.select(*cols[1])


def _signed(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.select("*", F.lit(-1).alias("__s")).unionByName(new.select("*", F.lit(1).alias("__s")))


def diff_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keyless difference as a multiset: each distinct row whose number of copies
    differs, with ``change`` ('added' | 'removed') and how many ``copies``.

    One aggregation over a signed union (partial aggregation first; rows are
    spread by all their columns, so no key can concentrate in one task). The
    copy count is reported, never replicated into rows. Frames of different columns are
    aligned by name first.
    """
    old, new = align_columns(old, new)
    cols = [_c(c) for c in old.columns]
    net = _signed(old, new).groupBy(*cols).agg(F.sum("__s").alias("__net")).where(F.col("__net") != 0)
    return net.select(
        *cols,
        F.when(F.col("__net") > 0, F.lit("added")).otherwise(F.lit("removed")).alias("change"),
        F.abs("__net").cast("bigint").alias("copies"),
    )


def diff_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str],
                changed_rows: tuple[DataFrame, DataFrame] | None = None, columns: bool = False) -> DataFrame:
    """Keys whose rows were added / removed / changed between two snapshots (J8).

    Exact and pair-free, so it holds for non-unique and hot keys: rows whose
    copy count differs are found by one aggregation over a signed union; key
    presence in each snapshot by a second one (pre-aggregated per key); the two
    meet in a null-safe join of one row per key each. A key present only in
    ``new`` is 'added', only in ``old`` 'removed', in both 'changed'.
    Columns: keys + ``change``.

    ``changed_rows=(old_part, new_part)``: parts of the two snapshots outside of
    which both are equal (e.g. the files two versions do not share); the row
    comparison then reads only those, key presence still uses the whole
    snapshots (key columns only).

    Snapshots of different schemas are aligned by column name: a row that gained a value in a new column has
    changed. ``columns`` adds ``changed_columns``: for a changed key with one old and one new row, the names of the columns
    that differ (in schema order); else NULL.
    """
    keys = list(keys)
    # key presence needs the keys only; the comparison needs all columns
    u = _signed(*align_columns(old.select(*[_c(k) for k in keys]), new.select(*[_c(k) for k in keys])))
    one, other = align_columns(*(changed_rows or (old, new)))
    cu, names = _signed(one, other), one.columns
    # One struct column as the key: struct equality treats NULL fields as equal
    # (null-safe), and both sides are aggregated by it, so the join reuses their
    # hash partitioning instead of shuffling again.
    key = F.struct(*[F.col(f"`{k}`") for k in keys]).alias("__key")
    net = cu.groupBy(*[_c(c) for c in names]).agg(F.sum("__s").alias("__net")).where(F.col("__net") != 0)
    row = F.struct(*[_c(c) for c in names])
    sides = [
        x for sign, name in ((-1, "old"), (1, "new")) for x in (
            F.first(F.when(F.signum("__net") == sign, row), ignorenulls=True).alias(f"__{name}"),
            F.sum(F.when(F.signum("__net") == sign, F.abs("__net"))).alias(f"__n_{name}"))
    ] if columns else [F.count(F.lit(1)).alias("__rows")]
    differing = net.groupBy(key).agg(*sides)
    presence = u.groupBy(key).agg(
        F.max(F.col("__s") < 0).alias("__in_old"), F.max(F.col("__s") > 0).alias("__in_new")
    )
    change = (
        F.when(~F.col("__in_old"), F.lit("added"))
        .when(~F.col("__in_new"), F.lit("removed"))
        .otherwise(F.lit("changed"))
    )
    out = [*[F.col(f"__key.`{k}`").alias(k) for k in keys], change.alias("change")]
    if columns:
        differ = F.array_compact(F.array(*[
            F.when(~F.col(f"__old.`{c}`").eqNullSafe(F.col(f"__new.`{c}`")), F.lit(c)) for c in names if c not in keys
        ]))
        out.append(F.when((F.col("__n_old") == 1) & (F.col("__n_new") == 1), differ).alias("changed_columns"))
    return differing.join(presence, "__key", "inner").select(*out)
