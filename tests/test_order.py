"""Sort expressions of a layout are worked out for each row, not for each comparison, and files still lie in their order."""

from __future__ import annotations

import glob

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from editpulse.sinks.tables import arrange, layout_for


def _fact(spark):
    rows = spark.range(20_000).selectExpr(
        "id AS edit_id", "timestamp_seconds(1775000000 + id * 37 % 200000) AS ts", "xxhash64(id % 90) AS page_id",
        "if(id % 11 = 0, null, xxhash64(id % 500, 1)) AS editor_id", "element_at(array('enwiki', 'dewiki', null), cast(id % 3 + 1 AS int)) AS wiki_id",
    )
    return rows.unionByName(rows.where("edit_id < 50"))


def test_a_sort_order_has_columns_alone(spark):
    plan = arrange(_fact(spark), layout_for("core.fact_edit"))._jdf.queryExecution().executedPlan().toString().split("\n")
    sorts = [line for line in plan if "Sort [" in line or "rangepartitioning" in line]
    assert len(sorts) == 2 and not any("shiftright" in line for line in sorts)


def test_files_lie_in_the_order_of_the_layout(spark, work_dir):
    layout, fact = layout_for("core.fact_edit"), _fact(spark)
    rows = arrange(fact, layout)
    assert rows.columns == [*fact.columns, "edit_date"]
    rows.write.partitionBy("edit_date").parquet(f"{work_dir}/fact")
    files = glob.glob(f"{work_dir}/fact/*/*.parquet")
    read = pa.concat_tables([pq.ParquetFile(f).read().append_column("file", pa.array([n] * pq.read_metadata(f).num_rows)) for n, f in enumerate(files)])
    assert read.num_rows == 20_050
    frame = read.to_pandas()
    frame["line"] = range(len(frame))
    placed = spark.createDataFrame(frame[["file", "line", "edit_id"]]).join(fact.distinct(), "edit_id")
    for name, by in enumerate(layout.sort_by):
        placed = placed.withColumn(f"by_{name}", F.expr(by))
    keys = [(r["file"], *[r[f"by_{k}"] for k in range(len(layout.sort_by))]) for r in placed.orderBy("line").collect()]
    assert keys == sorted(keys)
