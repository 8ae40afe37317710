"""Write the physical plans of the main operators to docs/PLANS.md.

Usage: python tools/show_plans.py [sf_dir]
Only the operator lines and scan details are kept (exchanges, joins,
aggregates, pushed / partition filters, read schemas).
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidewater import catalog as C  # noqa: E402
from tidewater.operators.counts import count_input  # noqa: E402
from tidewater.operators.merge import merge_upsert  # noqa: E402
from tidewater.plans import counts as CNT  # noqa: E402
from tidewater.plans import registry as REG  # noqa: E402
from tidewater.plans import structured as ST  # noqa: E402
from tidewater.plans.publish import post_images, stage_for_db  # noqa: E402
from tidewater.session import build_session  # noqa: E402
from tidewater.sources import feed, tables  # noqa: E402
from tidewater.sources.tables import BUCKET, bucket_of  # noqa: E402

KEEP = re.compile(r"^\s*(\+-|:|\(\d+\)|AdaptiveSparkPlan|PartitionFilters|PushedFilters|ReadSchema|Join type|"
                  r"Join condition|Arguments: hashpartitioning|Keys \[|Functions \[)")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    lines = [ln[:220] for ln in buf.getvalue().splitlines() if KEEP.match(ln)]
    return "\n".join(lines)


def main() -> None:
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "16"})
    out = ["# Physical plans of the main operators", "",
           f"Generated by `tools/show_plans.py` on `{d}` (local[8], AQE on; plans before adaptive re-planning).", ""]

    def section(title, note, df):
        out.extend([f"## {title}", "", note, "", "```", plan(df), "```", ""])

    e2 = C.entries()[1]
    raw = C.raw_table(spark, d)
    upd, cols = ST.build_update_set(ST.change_rows_of(ST.decode_rows(raw, e2, C.OPTS), e2, None), e2,
                                    tables.T.StructType(), C.OPTS)
    section("Update set: decode, split, types, trim, latest per key",
            "Schema-id filter pushed into the raw scan; split is a Generate (no shuffle); latest per key is a "
            "partial then final aggregate around one exchange on the key.", upd)

    path = C.flagship_table(spark, d)
    merged = merge_upsert(tables.read_table(spark, path), upd, ["RRN"], update_cols=cols)
    section("Merge, as written", "Each side is shuffled once on the keys; the write is rebalanced by bucket, so AQE sizes its tasks.",
            merged.withColumn(BUCKET, bucket_of(["RRN"], 16)).hint("rebalance", F.col(BUCKET)))

    section("Current table read", "Partition pruning on `_dir`, `_bucket`, `_row_kind`; two-column read schema.",
            tables.read_table(spark, path).select("RRN", "AMOUNT"))

    section("Change feed post images", "Only change-kind partitions of the requested versions are listed.",
            post_images(tables.read_change_feed(spark, path, 1)).select("RRN", "_change_type"))

    section("Database staging (latest per RRN)", "Partial/final aggregate, one exchange.",
            stage_for_db(post_images(tables.read_change_feed(spark, path, 0))))

    reg = REG.read_registry(spark, C.registry_table(spark, d, 3))
    section("Registry: new schema ids (dedup + anti-join)",
            "Dedup by partial aggregate; the registry side is broadcast after a bounded count.",
            REG.new_schema_ids(feed.metadata_envelopes(C.events(spark, d), 3), reg))
    section("Route rows to listed tables", "Registry broadcast; rows are not shuffled.",
            REG.route_tables(C.raw(spark, d, 3), reg, C.LISTED_TABLES))
    section("Count input of a batch", "Headers only, all schema ids in one pass; one aggregate with map-side partial counts follows.",
            CNT.batch_counts(raw, C.entries(), C.OPTS).groupBy("messageSchemaId", "rawLayerDate").count())
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md"),
              "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
