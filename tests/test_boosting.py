import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from keepwell.operators import boosting
from keepwell.operators.boosting import Grower, InTask, Settings, Tree, places, tables


def block(n=600, inputs=5, bins=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, bins, (n, inputs)).astype(np.uint16)
    y = (rng.random(n) < 0.15 + 0.5 * (x[:, 0] > 9) * (x[:, 1] < 4) + 0.2 * np.isin(x[:, 2], [1, 7, 11])).astype(float)
    return {"x": x, "y": y, "w": rng.uniform(0.5, 2, n), "key": rng.integers(0, 2**60, n), "margin": np.zeros(n)}


def exact_gain(g, h, left, l2):
    return 0.5 * sum(g[s].sum() ** 2 / (h[s].sum() + l2) for s in (left, ~left)) - 0.5 * g.sum() ** 2 / (h.sum() + l2)


def brute_best(b, rows, settings, bins=16):
    """(gain, rows to the left) of the best numeric split of some rows, by trying all."""
    g, h = (0.5 - b["y"][rows]) * b["w"][rows], 0.25 * b["w"][rows]
    best = (1e-9, None)
    for f in range(b["x"].shape[1]):
        for t in range(bins - 1):
            left = b["x"][rows, f] <= t
            if min(left.sum(), (~left).sum()) < max(1, settings.min_rows):
                continue
            if min(h[left].sum(), h[~left].sum()) < settings.min_hessian:
                continue
            gain = exact_gain(g, h, left, settings.l2)
            if gain > best[0] + 1e-9:
                best = (gain, left)
    return best


def grown_tree(b, settings, category=None, bins=16):
    inputs = b["x"].shape[1]
    category = np.zeros(inputs, bool) if category is None else category

    def ask(tree, nodes):
        return tables(b, tree, nodes, 0, settings.row_share, bins)

    return Grower(ask, bins, category, np.ones(inputs, bool), settings).grow()


def leaf_sets(tree: Tree, x):
    at = places(tree.arrays(), x)
    return {int(n): np.flatnonzero(at == n) for n in np.unique(at)}


def check_values(b, tree, settings):
    for node, rows in leaf_sets(tree, b["x"]).items():
        g, h = ((0.5 - b["y"]) * b["w"])[rows].sum(), (0.25 * b["w"])[rows].sum()
        assert tree.value[node] == pytest.approx(-settings.rate * g / (h + settings.l2))


def test_level_wise_trees_equal_brute_force():
    b, settings = block(), Settings(rounds=1, depth=4, min_hessian=3.0)
    expected, level = [], [np.arange(600)]
    for _ in range(4):
        following = []
        for rows in level:
            gain, left = brute_best(b, rows, settings)
            if left is None:
                expected.append(rows)
            else:
                following += [rows[left], rows[~left]]
        level = following
    tree = grown_tree(b, settings)
    got = sorted(tuple(r) for r in leaf_sets(tree, b["x"]).values())
    assert got == sorted(tuple(r) for r in expected + level)
    check_values(b, tree, settings)


@pytest.mark.parametrize("ahead", [1, 8])
def test_best_first_trees_equal_brute_force(ahead, monkeypatch):
    monkeypatch.setattr(boosting, "AHEAD", ahead)
    b, settings = block(seed=2), Settings(rounds=1, leaves=11, min_rows=12)
    leaves = [np.arange(600)]
    while len(leaves) < settings.leaves:
        found = [brute_best(b, rows, settings) for rows in leaves]
        k = max(range(len(leaves)), key=lambda i: found[i][0] if found[i][1] is not None else -1)
        if found[k][1] is None:
            break
        rows = leaves.pop(k)
        leaves += [rows[found[k][1]], rows[~found[k][1]]]
    tree = grown_tree(b, settings)
    assert sorted(map(tuple, leaf_sets(tree, b["x"]).values())) == sorted(map(tuple, leaves))
    assert sum(x < 0 for x in tree.left) - sum(x >= 0 for x in tree.left) >= 1
    check_values(b, tree, settings)


def test_symmetric_trees_equal_brute_force():
    b, settings = block(seed=3), Settings(rounds=1, depth=3, symmetric=True, l2=3.0)
    g, h = (0.5 - b["y"]) * b["w"], 0.25 * b["w"]
    cells = np.zeros(600, int)
    for _ in range(3):
        scores = {}
        for f in range(5):
            for t in range(15):
                both = cells * 2 + (b["x"][:, f] > t)
                scores[f, t] = sum(g[both == c].sum() ** 2 / (h[both == c].sum() + 3) for c in np.unique(both))
        f, t = max(scores, key=scores.get)
        cells = cells * 2 + (b["x"][:, f] > t)
    tree = grown_tree(b, settings)
    at = places(tree.arrays(), b["x"])
    assert len(set(zip(at.tolist(), cells.tolist(), strict=True))) == len(set(cells.tolist())) == len(set(at.tolist()))
    check_values(b, tree, settings)


def test_splits_by_levels():
    """The best set of levels is a prefix in the order of their gradient ratios; other levels go right."""
    b = block(seed=4)
    b["x"][:, 2] %= 13
    settings = Settings(rounds=1, leaves=2, min_rows=5)
    only = np.array([False, False, True, False, False])
    table = tables(b, grown_tree(b, Settings(rounds=1, leaves=1)).arrays(), [0], 0, 1.0, 16)[0]
    found = boosting.best_split(table, only, only, settings)
    g, h = (0.5 - b["y"]) * b["w"], 0.25 * b["w"]
    ratio = {c: g[b["x"][:, 2] == c].sum() / (h[b["x"][:, 2] == c].sum() + boosting.CAT_SMOOTH) for c in range(13)}
    order = sorted(ratio, key=ratio.get)
    gains = {}
    for k in range(1, 13):
        left = np.isin(b["x"][:, 2], order[:k])
        both = sum(g[s].sum() ** 2 / (h[s].sum() + settings.l2 + boosting.CAT_L2) for s in (left, ~left))
        gains[k] = 0.5 * (both - g.sum() ** 2 / (h.sum() + settings.l2))
    best = max(gains, key=gains.get)
    assert set(np.flatnonzero(found.goes_left)) == set(order[:best]) and found.gain == pytest.approx(gains[best])


def test_row_samples():
    key = np.random.default_rng(0).integers(0, 2**62, 20_000)
    some = [boosting.sampled(key, t, 0.8) for t in range(3)]
    assert all(abs(s.mean() - 0.8) < 0.02 for s in some) and (some[0] != some[1]).any()
    assert boosting.sampled(key, 1, 1.0).all()


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(1500):
        x = [float(v) for v in rng.normal(size=4).round(2)] + [float(rng.integers(0, 6))]
        churn = int(rng.random() < 1 / (1 + np.exp(2 - 2 * x[0] + 1.5 * x[1] * (x[4] > 2))))
        rows.append((i, churn, 2.0 if churn else 1.0, x))
    frame = spark.createDataFrame(rows, "id long, y int, w double, x array<double>").repartition(5)
    meta = {"ml_attr": {"attrs": {"nominal": [{"idx": 4, "vals": list("abcde")}]}}}
    vector = frame.withColumn("features", array_to_vector("x"))
    return vector.withColumn("features", F.col("features").alias("features", metadata=meta)).cache()


NAMES = [f"x{k}" for k in range(5)]


@pytest.mark.parametrize(
    "settings",
    [
        Settings(rounds=25, depth=4, min_hessian=2.0, row_share=0.8, column_share=0.8),
        Settings(rounds=25, leaves=8, min_rows=20, average_start=True),
        Settings(rounds=25, depth=3, symmetric=True, l2=3.0),
    ],
)
def test_one_block_and_many_grow_the_same_trees(train, settings, monkeypatch):
    one = boosting.fit(train, NAMES, settings, "y", "w", "id")
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 600)
    many = boosting.fit(train.repartition(7), NAMES, settings, "y", "w", "id")
    assert [t["feature"] for t in one.state["trees"]] == [t["feature"] for t in many.state["trees"]]
    for a, b in zip(one.state["trees"], many.state["trees"], strict=True):
        assert a["goes_left"] == b["goes_left"] and a["value"] == pytest.approx(b["value"])
    scores = {r.id: r.risk for r in one.transform(train).select("id", vector_to_array("probability")[1].alias("risk")).collect()}
    labels = {r.id: r.y for r in train.collect()}
    churned = np.mean([scores[i] for i in scores if labels[i]])
    assert all(0 < s < 1 for s in scores.values()) and churned > np.mean([scores[i] for i in scores if not labels[i]]) + 0.15


def test_stored_in_a_pipeline(spark, train, tmp_path):
    model = PipelineModel([boosting.fit(train, NAMES, Settings(rounds=5, leaves=6), "y", "w", "id")])
    model.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    before, after = (m.transform(train).select("id", "probability") for m in (model, loaded))
    assert {r.id: list(r.probability) for r in before.collect()} == {r.id: list(r.probability) for r in after.collect()}
    shares = loaded.stages[0].featureImportances.toArray()
    assert len(shares) == 5 and shares.sum() == pytest.approx(1) and shares.argmax() in (0, 1, 4)
    assert model.transform(train.limit(0)).collect() == []


def test_a_label_that_never_changes(train):
    model = boosting.fit(train.withColumn("y", F.lit(0)), NAMES, Settings(rounds=3, depth=2, average_start=True), "y", "w", "id")
    assert model.transform(train).filter(vector_to_array("probability")[1] >= 0.5).count() == 0


def test_ordered_statistics(spark):
    rows = [(i, "a" if i % 3 else None if i % 2 else "b", i % 5 == 0, ["train", "train", "test"][i % 3]) for i in range(300)]
    rows.append((1000, "new", True, "test"))
    frame = spark.createDataFrame([(i, c, int(y), r) for i, c, y, r in rows], "id long, c string, y int, role string")
    draw = F.pmod(F.col("id") * 2654435761, F.lit(1 << 32))
    got = {r.id: r.c_stat for r in boosting.ordered_statistics(frame.repartition(3), ["c"], "y", "id", draw, 0.25).collect()}
    order = sorted(rows, key=lambda r: (r[0] * 2654435761 % (1 << 32), r[0]))
    for i, c, _, role in rows:
        place = [r[0] for r in order].index(i)
        seen = [r[2] for r in (order[:place] if role == "train" else order) if r[3] == "train" and r[1] == c]
        assert got[i] == pytest.approx((sum(seen) + 0.25) / (len(seen) + 1))
    assert len(got) == len(rows) and isinstance(InTask(block()).totals(), np.ndarray)


@pytest.mark.parametrize(
    "settings",
    [
        Settings(rounds=3, depth=4, row_share=0.7),
        Settings(rounds=3, leaves=9, min_rows=5),
        Settings(rounds=3, depth=3, symmetric=True, row_share=0.7),
    ],
)
def test_passes_that_go_on_from_the_last_one_equal_passes_from_the_root(settings, monkeypatch):
    asked = []

    class Checked(InTask):
        def ask(self, tree, nodes, number, share, bins):
            found = super().ask(tree, nodes, number, share, bins)
            assert np.array_equal(found, tables(self.block, tree, nodes, number, share, bins))
            asked.append(number)
            return found

    boosting.grown(Checked(block(seed=9)), np.array([False, False, True, False, False]), 16, settings)
    assert set(asked) == {0, 1, 2} and len(asked) > 6


def test_a_partition_of_rows_sends_the_driver_no_tables(spark, monkeypatch):
    def refused(self, blocks):
        raise AssertionError("a job a pass")

    monkeypatch.setattr(boosting.ByJobs, "__init__", refused)
    x = F.array((F.col("id") % 97).cast("double"), (F.col("id") % 89).cast("double"))
    rows = spark.range(30_000).select("id", array_to_vector(x).alias("features"), F.lit(1.0).alias("w"), (F.col("id") % 97 > 60).cast("int").alias("y"))
    model = boosting.fit(rows, ["a", "b"], Settings(rounds=2, depth=2), "y", "w", "id")
    assert [t["feature"][0] for t in model.state["trees"]] == [0, 0]
