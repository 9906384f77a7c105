"""Weekly marts from daily states equal those from history."""

import pytest
from pyspark.sql import functions as F

from siftline.plans import marts, rollup
from siftline.schemas import SEEN, struct_of
from tests.conftest import AS_OF

WHOLE = {"weekly_source": marts.weekly_source, "weekly_company_type": marts.weekly_company_type, "weekly_experience": marts.weekly_experience}


def seen_rows(spark, n=60):
    blank = spark.createDataFrame([], struct_of(SEEN))
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("dedup_key"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.expr("timestampadd(HOUR, -cast(id * 5 as int), timestamp'2024-01-31 00:00:00')").alias("first_seen"),
        F.when(F.col("id") % 4 > 0, (F.col("id") * 7 % 100).cast("double")).alias("ai_match_score"),
        F.when(F.col("id") % 5 == 0, "").otherwise("c").alias("company_type"), F.lit("verified").alias("company_type_confidence"),
        F.when(F.col("id") % 2 == 0, "").otherwise("3").alias("experience_required"), (F.col("id") % 2).cast("int").alias("prefilter_passed"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("2024-01-0"), F.col("id") % 9 + 1)).otherwise("?").alias("posted_date"),
    )
    return blank.unionByName(rows, allowMissingColumns=True)


def cells(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=repr)


@pytest.mark.parametrize("mart", WHOLE)
def test_states_merge_to_the_whole(spark, tmp_path, mart):
    seen, root = seen_rows(spark), str(tmp_path)
    rollup.add_states(rollup.day_states(seen.where("dedup_key % 2 = 0"), mart), root, mart, 0)
    for _ in range(2):  # a late batch, run twice
        rollup.add_states(rollup.day_states(seen.where("dedup_key % 2 = 1"), mart), root, mart, 1)
    assert cells(rollup.weekly(rollup.read_states(spark, root, mart), mart, AS_OF)) == cells(WHOLE[mart](seen, AS_OF))
    # Rows of one source are taken out, and those of another change.
    gone = seen.where("source = 's1'")
    changed = seen.where("source = 's2'").withColumn("ai_match_score", F.lit(50.0))
    moves = rollup.day_states(gone, mart, -1).unionByName(rollup.day_states(seen.where("source = 's2'"), mart, -1))
    rollup.add_states(moves.unionByName(rollup.day_states(changed, mart)), root, mart, 2)
    now = seen.where("source = 's0'").unionByName(changed)
    assert cells(rollup.weekly(rollup.read_states(spark, root, mart), mart, AS_OF)) == cells(WHOLE[mart](now, AS_OF))
