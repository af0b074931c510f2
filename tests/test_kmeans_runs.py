"""KMeans runs made side by side are MLlib's runs: draws, centres, cost, iterations; and need few jobs."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from orderlens.operators import draws as D
from orderlens.operators import lloyd as L
from orderlens.plans import models as M

JOBS = [(2, 42), (3, 43), (7, -5)]


def points(spark, values, parts=4):
    rows = [(f"c{i}", Vectors.dense(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, ["customer_id", "features"]).repartition(
        parts, "customer_id").sortWithinPartitions("customer_id").cache()


def values(n, seed=0):
    rng = np.random.default_rng(seed)
    return np.round(rng.normal(0, 1, (n, 3)) + rng.integers(0, 3, (n, 1)) * 2, 2).tolist()


CASES = {"many": values(900), "few": values(12), "one": values(1), "equal": [[1.0, 2.0, 3.0]] * 30,
         "two places": [[0.0, 0.0, 0.0], [1.0, 5.0, 2.0]] * 40, "mirrored": [[float(x), float(y), 0.0] for x in range(-5, 6) for y in range(-5, 6)]}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("local_bytes", [L.LOCAL_BYTES, 0])
def test_runs_are_mllibs(spark, case, local_bytes):
    rows = points(spark, CASES[case])
    jobs = JOBS if case == "many" else [(3, 42)]
    for most in (0, 12):
        for job, fit in zip(jobs, L.fits(rows, "features", jobs, most, 1e-4, local_bytes)):
            model = M._kmeans(*job).setSolver("row").setMaxIter(most).fit(rows)     # blocks fail on fewer places than k
            assert np.allclose(np.array(model.clusterCenters()), fit.centres, rtol=0, atol=1e-9)
            if most:
                assert abs(model.summary.trainingCost - fit.cost) < 1e-9 * (1 + fit.cost) and model.summary.numIter == fit.iterations
    rows.unpersist()


def test_model_of_a_run_scores_and_saves_like_mllibs(spark, tmp_path):
    rows = points(spark, CASES["many"])
    best = M._best_fits(rows, [4], 42, 1, 1)[4]
    plain = M._kmeans(4, 42).fit(rows)
    assert best.transform(rows).collect() == plain.transform(rows).collect()
    assert best.summary.clusterSizes == plain.summary.clusterSizes and best.summary.numIter == plain.summary.numIter
    assert [best.getK(), best.getSeed(), best.getMaxIter(), best.getTol()] == [plain.getK(), plain.getSeed(), plain.getMaxIter(), plain.getTol()]
    best.write().overwrite().save(f"file://{tmp_path}/model")
    assert M.KMeansModel.load(f"file://{tmp_path}/model").transform(rows).collect() == plain.transform(rows).collect()
    rows.unpersist()


def test_a_search_needs_few_jobs(spark):
    def last_job():
        spark.sparkContext.setJobGroup("count", "")
        spark.range(1).count()
        return max(spark.sparkContext.statusTracker().getJobIdsForGroup("count"))

    rows = points(spark, CASES["many"])
    rows.count()
    before = last_job()
    M._best_fits(rows, [2, 3, 4], 42, 5, 2)
    assert last_job() - before < 20              # 15 runs one by one are some 200 jobs
    rows.unpersist()


def test_numbers_from_any_position(spark):
    java = spark._jvm.org.apache.spark.util.random.XORShiftRandom(-77)
    want = [java.nextDouble() for _ in range(500)]
    assert D.uniform(-77, 0, 500).tolist() == want and D.uniform(-77, 123, 300).tolist() == want[123:423]
    assert D.seed_of(99) == spark._jvm.org.apache.spark.util.random.XORShiftRandom(99).nextInt()
    java, own = spark._jvm.java.util.Random(-9), D.JavaRandom(-9)
    assert [java.nextInt(n) for n in (7, 8, 1000, 3)] == [own.below(n) for n in (7, 8, 1000, 3)]
    assert (java.nextLong(), java.nextDouble()) == (own.long(), own.double())


def test_one_of_is_spark_takes(spark):
    for n in (1, 2, 5, 40, 3000):
        rows = spark.range(0, n, 1, 3)
        sizes = [len(x) for x in rows.rdd.glom().collect()]
        for seed in (1, -12345):
            part, at = D.one_of(sizes, seed)
            assert rows._jdf.javaRDD().takeSample(False, 1, seed)[0] == sum(sizes[:part]) + at
