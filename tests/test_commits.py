import pytest
from pyspark.sql import functions as F

from flowlens.sources.tables import read_table, write_batch
from flowlens.streaming import commits as C
from flowlens.streaming.scoring import batch_writer


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "sink"), str(tmp_path / "commits")


def batch(spark, n, rows=3):
    return spark.range(100 * n, 100 * n + rows).withColumn("x", F.col("id") * 2)


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def written(spark, paths, batches, committed=None):
    for n in batches:
        write_batch(batch(spark, n), paths[0], n)
        if committed is None or n in committed:
            C.commit(spark, paths[1], n, 3)


def want(*batches):
    return sorted(100 * n + i for n in batches for i in range(3))


def test_only_committed_batches_are_seen(spark, paths):
    written(spark, paths, [0, 1, 2], committed=[0, 2])
    assert ids(C.read_committed(spark, *paths)) == want(0, 2)
    C.commit(spark, paths[1], 1, 3)
    assert ids(C.read_committed(spark, *paths)) == want(0, 1, 2)
    assert C.commits(spark, paths[1]).agg(F.sum("rows")).first()[0] == 9


def test_nothing_written_yet(spark, paths):
    assert C.commits(spark, paths[1]).count() == 0 and C.markers(spark, paths[0]).count() == 0
    with pytest.raises(FileNotFoundError):
        C.read_committed(spark, *paths)
    assert C.compact(spark, *paths) is None and C.drop_compacted(spark, paths[0]) == 0


def test_a_run_counts_from_its_marker_on(spark, paths):
    written(spark, paths, range(4), committed=[0, 1, 3])
    before = C.read_committed(spark, *paths)
    run = C.write_run(spark, *paths, before=3)  # a crash here leaves a run that nobody reads
    assert ids(C.read_committed(spark, *paths)) == want(0, 1, 3)
    C.publish(spark, paths[0], run)
    assert ids(before) == ids(C.read_committed(spark, *paths)) == want(0, 1, 3)
    again = C.compact(spark, *paths)
    assert again not in (None, run) and ids(C.read_committed(spark, *paths)) == want(0, 1, 3)
    assert C.compact(spark, *paths) is None
    # a batch that is committed later is neither lost nor doubled
    C.commit(spark, paths[1], 2, 3)
    assert ids(C.read_committed(spark, *paths)) == want(0, 1, 2, 3)


def test_old_folders_go_only_after_a_while(spark, paths):
    written(spark, paths, range(3))
    C.compact(spark, *paths, before=2)
    assert C.drop_compacted(spark, paths[0], "1 hour") == 0
    assert C.drop_compacted(spark, paths[0], "0 seconds") == 2 and C.drop_compacted(spark, paths[0], "0 seconds") == 0
    assert {r.batch_id for r in read_table(spark, paths[0]).collect()} == {2}
    seen = C.read_committed(spark, *paths)
    assert ids(seen) == want(0, 1, 2) and seen.where("x = 2 * id").count() == 9


def test_compacted_rows_lie_in_few_files_by_day(spark, paths):
    written(spark, paths, range(6))
    run = C.compact(spark, *paths)
    files = spark.read.parquet(f"{paths[0]}_runs/run={run}")
    assert files.select("day").distinct().count() <= 2 and len(files.inputFiles()) <= 2


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    sink, log = str(tmp_path / "s"), str(tmp_path / "c")
    calls = []

    def score(df):
        calls.append(1)
        return df

    write = batch_writer(score, {sink: ["id"]}, commit_path=log)
    write(batch(spark, 0), 0)
    write(batch(spark, 5), 0)  # a replay that would give other rows
    assert len(calls) == 1 and ids(C.read_committed(spark, sink, log)) == want(0)
    write(batch(spark, 1, rows=0), 1)
    assert {r.batch_id: r.rows for r in C.commits(spark, log).collect()} == {0: 3, 1: 0}
    C.compact(spark, sink, log)
    assert ids(C.read_committed(spark, sink, log)) == want(0)
