"""Even ranges of skewed games, and a landing that goes on."""

import pytest

from pitchlake.session import scratch_path
from pitchlake.sources import JdbcSource
from pitchlake.sources.ranges import RangeSize, counter, keep_ranges, predicates, range_bounds

SOURCE = JdbcSource("jdbc:mysql://host/db", {})


class Database:
    """Answers what a database would be asked, from views; may break off."""

    def __init__(self, spark, breaks_at=None):
        self.spark, self.breaks_at, self.asked = spark, breaks_at, []
        self._jvm, self._jsc = spark._jvm, spark._jsc

    @property
    def read(self):
        return self

    def parquet(self, *paths):
        return self.spark.read.parquet(*paths)

    def jdbc(self, url, table, predicates=None, properties=None):
        if not predicates:
            return self.spark.sql(f"SELECT * FROM {table}")
        if len(self.asked) == self.breaks_at:
            raise OSError("gone")
        self.asked.append(predicates)
        return self.spark.sql(" UNION ALL ".join(f"SELECT * FROM {table} WHERE {p}" for p in predicates))


@pytest.fixture(scope="module")
def view(spark):
    """Half of the rows in a few games close together, one game of 900 rows, the
    rest far apart; rows without a game and outside the range."""
    spark.range(6000).selectExpr(
        "case when id < 3000 then 700000 + id % 40 when id < 3900 then 65536"
        " when id < 5990 then id * 200 when id < 5995 then null else 5000000 end game_seq",
        "id n",
    ).createOrReplaceTempView("skewed")
    return spark.table("skewed")


def test_ranges_are_even(spark, view):
    size = RangeSize(rows=200, cells=16, spans=3)
    bounds = range_bounds(counter(Database(spark), SOURCE, "skewed"), (0, 1_200_000), size)
    assert bounds == sorted(set(bounds))
    conditions = predicates(bounds)
    counts = [view.where(p).count() for p in (conditions[0], conditions[-1])]
    inside = view.selectExpr(*[f"count_if({p}) c{i}" for i, p in enumerate(conditions)]).first()
    assert sum(inside) == 6000 and [inside[0], inside[-1]] == counts
    assert sorted(inside)[-1] >= 900 and sorted(inside)[-2] <= 200 + 10  # the one game; rows outside go to the ends
    assert len(conditions) < 2 * 6000 / 200
    in_steps = range_bounds(counter(Database(spark), SOURCE, "skewed"), (0, 1_200_000), RangeSize(rows=10**6))
    assert in_steps == [] and view.where(predicates([])[0]).count() == 6000
    assert range_bounds(lambda spans, width: {}, (5, 5)) == []
    with pytest.raises(ValueError):
        range_bounds(lambda spans, width: {}, (-1, 5))


def test_a_landing_goes_on(spark, view):
    folder, size = scratch_path(spark, "ranges"), RangeSize(rows=400, per_job=4)
    broken = Database(spark, breaks_at=2)
    with pytest.raises(OSError):
        keep_ranges(broken, SOURCE, "skewed", folder, (0, 1_200_000), size)
    # Half of a job's files, of a run that died, are not read.
    view.limit(7).write.parquet(f"{folder}/2-dead")
    again = Database(spark)
    kept = keep_ranges(again, SOURCE, "skewed", folder, (0, 1_200_000), size)
    assert len(broken.asked) == 2 and again.asked and not {tuple(p) for p in broken.asked} & {tuple(p) for p in again.asked}
    assert kept.count() == 6000 and kept.exceptAll(view).count() == 0
    done = Database(spark)
    assert keep_ranges(done, SOURCE, "skewed", folder, (0, 1_200_000), size).count() == 6000 and done.asked == []
