"""Sequence-guarded upsert with partial columns and change rows (SEM-5/6/8/14).

Contract (keys compared null-safe, each side unique per key):

* take   = update present and (existing absent or update.seq > existing.seq);
           a NULL comparison is false, so a NULL existing sequence never updates.
* column = take and existing absent     -> update value (NULL if not sent)
           take and column updatable    -> update value
           otherwise                    -> existing value
* result = existing columns, then new update columns in their order (SEM-8).

Deletes are never physical: a DELETE row is upserted as a tombstone.

The output carries ``_row_kind``: ``C`` unchanged, ``I`` inserted, ``U``
updated (post image) and ``P`` the pre image of an update. One full outer
join produces both the next snapshot (C, I, U) and the change rows (I, U, P).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_KIND = "_row_kind"
SNAPSHOT_KINDS = ("C", "I", "U")
CHANGE_KINDS = {"I": "insert", "U": "update_postimage", "P": "update_preimage", "D": "delete"}


def merge_upsert(existing: DataFrame, updates: DataFrame, keys: list[str], seq: str = "_changeSequence",
                 update_cols: list[str] | None = None) -> DataFrame:
    """See the module contract."""
    e_cols = [c for c in existing.columns if c != ROW_KIND]
    u_cols = [c for c in updates.columns if c != ROW_KIND]
    e_by_upper = {c.upper(): c for c in e_cols}
    u_by_upper = {c.upper(): c for c in u_cols}
    new_cols = [c for c in u_cols if c.upper() not in e_by_upper]
    result = e_cols + new_cols
    updatable = {c.upper() for c in (update_cols if update_cols is not None else u_cols)}
    e_types = {f.name: f.dataType for f in existing.schema.fields}
    u_types = {f.name: f.dataType for f in updates.schema.fields}

    e_alias = {c: f"__e{i}" for i, c in enumerate(e_cols)}
    u_alias = {c: f"__u{i}" for i, c in enumerate(u_cols)}
    left = existing.select(*[F.col(f"`{c}`").alias(a) for c, a in e_alias.items()], F.lit(True).alias("__ep"))
    right = updates.select(*[F.col(f"`{c}`").alias(a) for c, a in u_alias.items()], F.lit(True).alias("__up"))

    def e_of(name: str):
        return F.col(e_alias[e_by_upper[name.upper()]])

    def u_of(name: str):
        return F.col(u_alias[u_by_upper[name.upper()]])

    conds = [e_of(k).eqNullSafe(u_of(k)) for k in keys]
    joined = left.join(right, reduce(lambda a, b: a & b, conds), "full_outer")

    e_present = F.col("__ep").isNotNull()
    take = F.col("__up").isNotNull() & (~e_present | F.coalesce(u_of(seq) > e_of(seq), F.lit(False)))

    post, pre = [], []
    for c in result:
        up = c.upper()
        in_e, in_u = up in e_by_upper, up in u_by_upper
        dtype = e_types[c] if in_e else u_types[c]
        ev = e_of(c) if in_e else F.lit(None).cast(dtype)
        uv = u_of(c).cast(dtype) if in_u else F.lit(None).cast(dtype)
        if in_u and up in updatable:
            value = F.when(take, uv).otherwise(ev)
        else:
            value = F.when(take & ~e_present, uv).otherwise(ev)
        post.append(value.alias(c))
        pre.append(ev.alias(c))

    kind = F.when(take & ~e_present, "I").when(take, "U").otherwise("C")
    rows = F.when(
        kind == "U",
        F.array(F.struct(*post, F.lit("U").alias(ROW_KIND)), F.struct(*pre, F.lit("P").alias(ROW_KIND))),
    ).otherwise(F.array(F.struct(*post, kind.alias(ROW_KIND))))
    return joined.select(F.explode(rows).alias("__r")).select("__r.*")


def merge_versions(existing: DataFrame | None, updates: DataFrame, keys: list[str], versions: list[tuple[str, list[str]]],
                   seq: str = "_changeSequence") -> DataFrame:
    """The module contract for several update sets of one table in a row, in one join.

    ``updates`` has one row per key: the key columns and, for each of ``versions``
    (name, columns it may update), a struct with that set's row or NULL. The
    sets apply in order, each to what those before it left; the change rows show
    what came of all of them together. ``existing`` is None for a new table."""
    e_cols = [c for c in existing.columns if c != ROW_KIND] if existing is not None else []
    types = {f.name.upper(): f.dataType for f in existing.schema.fields} if existing is not None else {}
    names = {c.upper(): c for c in e_cols}
    right = updates.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], *[v for v, _ in versions])
    if existing is None:
        rows = right.withColumn("__ep", F.lit(False))
    else:
        e_alias = {c.upper(): f"__e{i}" for i, c in enumerate(e_cols)}
        left = existing.select(*[F.col(f"`{c}`").alias(e_alias[c.upper()]) for c in e_cols], F.lit(True).alias("__in"))
        conds = [F.col(e_alias[k.upper()]).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        rows = left.join(right, reduce(lambda a, b: a & b, conds), "full_outer").withColumn("__ep", F.col("__in").isNotNull())
    before = {u: F.col(f"__e{i}") for i, u in enumerate(names)}
    state = {u: (f"__s{i}", before[u]) for i, u in enumerate(names)}
    rows = rows.select("*", *[c.alias(a) for a, c in state.values()], F.col("__ep").alias("__has"), F.lit(False).alias("__changed"))
    kept = [c for c in rows.columns if not c.startswith("__s") and c not in ("__has", "__changed")]
    slots = {u: a for u, (a, _) in state.items()}
    for version, may_update in versions:
        fields = {f.name.upper(): f for f in updates.schema[version].dataType.fields}
        updatable = {c.upper() for c in may_update}
        newer = F.col(f"{version}.`{fields[seq.upper()].name}`") > F.col(slots[seq.upper()]) if seq.upper() in slots else F.lit(False)
        rows = rows.withColumn("__take", F.col(version).isNotNull() & (~F.col("__has") | F.coalesce(newer, F.lit(False))))
        out = {}
        for u, slot in slots.items():
            if u in fields:
                use = F.col("__take") if u in updatable else F.col("__take") & ~F.col("__has")
                out[slot] = F.when(use, F.col(f"{version}.`{fields[u].name}`").cast(types[u])).otherwise(F.col(slot))
            else:
                out[slot] = F.col(slot)
        for u, f in fields.items():
            if u not in slots:
                slots[u], names[u], types[u] = f"__s{len(slots)}", f.name, f.dataType
                out[slots[u]] = F.when(F.col("__take") if u in updatable else F.col("__take") & ~F.col("__has"), F.col(f"{version}.`{f.name}`"))
        rows = rows.select(*kept, *[c.alias(a) for a, c in out.items()], (F.col("__has") | F.col("__take")).alias("__has"),
                           (F.col("__changed") | F.col("__take")).alias("__changed"))
    post = [F.col(slots[u]).alias(n) for u, n in names.items()]
    pre = [before.get(u, F.lit(None).cast(types[u])).alias(n) for u, n in names.items()]
    kind = F.when(F.col("__changed") & ~F.col("__ep"), "I").when(F.col("__changed"), "U").otherwise("C")
    both = F.when(kind == "U", F.array(F.struct(*post, F.lit("U").alias(ROW_KIND)), F.struct(*pre, F.lit("P").alias(ROW_KIND)))) \
        .otherwise(F.array(F.struct(*post, kind.alias(ROW_KIND))))
    return rows.select(F.explode(both).alias("__r")).select("__r.*")


def snapshot_rows(merged: DataFrame) -> DataFrame:
    """Rows of the next snapshot, without the kind column."""
    return merged.filter(F.col(ROW_KIND).isin(*SNAPSHOT_KINDS)).drop(ROW_KIND)


def change_rows(merged: DataFrame) -> DataFrame:
    """Change rows with ``_change_type`` (insert / update_preimage / update_postimage / delete)."""
    mapping = F.create_map(*[x for k, v in CHANGE_KINDS.items() for x in (F.lit(k), F.lit(v))])
    return (merged.filter(F.col(ROW_KIND).isin(*CHANGE_KINDS))
            .withColumn("_change_type", mapping[F.col(ROW_KIND)]).drop(ROW_KIND))
