import numpy as np
import pytest
from pyspark.sql import functions as F

from meterhawk import schema as S
from meterhawk.operators import covariance as CO
from meterhawk.operators import forest as FO
from meterhawk.operators import training as TR
from meterhawk.operators.features import stream_features
from meterhawk.plans import diagnostics as DI
from meterhawk.plans import samples
from meterhawk.sources import models as MO
from meterhawk.sources.files import delete

COLUMNS = ["a", "b", "c"]


def points_frame(spark, points):
    rows = [(i, *map(float, p)) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "id long, " + ", ".join(f"{c} double" for c in COLUMNS[: len(points[0])]))


@pytest.fixture(scope="module")
def planted(spark):
    """1,000 regular rows and 20 far ones."""
    rng = np.random.default_rng(7)
    return points_frame(spark, np.vstack([rng.normal(size=(1000, 3)), rng.normal(12, 1, size=(20, 3))])).persist()


def trees_of(df, **options):
    rows = FO.fit_forest(df, COLUMNS, ["id"], 20, 64, **options).collect()
    return sorted((r.tree, bytes(r.feature), bytes(r.value), bytes(r.child), r.sample_rows) for r in rows)


def test_forest_does_not_depend_on_partitioning(planted):
    assert trees_of(planted.repartition(3)) == trees_of(planted.repartition(11, "b").sortWithinPartitions("c"))
    assert trees_of(planted, seed=1) != trees_of(planted, seed=2)


def test_every_tree_draws_exactly_its_sample(planted):
    assert {t[4] for t in trees_of(planted)} == {64}


def test_sample_is_capped_by_the_rows(spark):
    df = points_frame(spark, np.random.default_rng(0).normal(size=(30, 3)))
    assert {t[4] for t in trees_of(df)} == {30}


def test_planted_outliers_rank_highest_and_share_matches(spark, planted):
    forest = FO.load_forest(FO.fit_forest(planted, COLUMNS, ["id"], 100, 256), COLUMNS)
    scored = planted.withColumn("s", FO.forest_score(spark, forest)).persist()
    top = {r.id for r in scored.orderBy(F.desc("s")).limit(20).collect()}
    assert top == set(range(1000, 1020))
    cut = FO.decision_cut(scored, "s", 0.03)
    assert FO.decision_cut(scored, "s", 0.03, staged=True) == cut
    assert cut == pytest.approx(np.percentile([r.s for r in scored.collect()], 97), rel=1e-12)
    flagged = FO.score_forest(planted, FO.with_cut(forest, cut)).agg(F.avg("if_flag")).first()[0]
    assert abs(flagged - 0.03) < 0.002


def test_equal_copies_are_drawn_apart(spark):
    """A third of all rows are one copied point: each tree holds its share of them, not all or none."""
    rng = np.random.default_rng(3)
    df = points_frame(spark, np.vstack([rng.normal(size=(2000, 3)), np.full((1000, 3), 9.0)]))
    for _, feature, value, _, rows in trees_of(df):
        assert rows == 64
        assert (np.frombuffer(feature, np.int8) >= 0).any()


def test_weights_raise_the_chance_of_being_drawn():
    keys = np.arange(20_000, dtype=np.uint64)
    weights = np.where(keys < 2000, 3.0, 1.0)
    draws = -np.log(FO.uniforms(keys, 5)) / weights
    chosen = np.argsort(draws)[:1000]
    assert 0.2 < (chosen < 2000).mean() < 0.3  # 6000 of 24000 weight


def test_thinned_input_still_fills_every_sample(spark):
    df = spark.range(60_000, numPartitions=4).select(
        "id", *[F.randn(i).alias(c) for i, c in enumerate(COLUMNS)]
    )
    rows = FO.fit_forest(df, COLUMNS, ["id"], 4, 32).collect()
    assert {r.sample_rows for r in rows} == {32}


def test_any_number_of_weights(spark):
    """Every row has a weight of its own; rows without a positive one are never drawn."""
    df = spark.range(8000).select("id", *[F.col("id").cast("double").alias(c) for c in COLUMNS])
    weight = F.when(F.col("id") % 4 == 0, 0.0).when(F.col("id") % 4 == 1, None).otherwise(F.col("id") * F.col("id") + 1.0)
    held = []
    for r in FO.fit_forest(df, COLUMNS, ["id"], 40, 128, weight=weight).collect():
        assert r.sample_rows == 128
        value, feature = np.frombuffer(r.value, np.float32), np.frombuffer(r.feature, np.int8)
        held += value[feature >= 0].tolist()
    # A weight that grows with the square of the number draws from the upper end.
    assert np.median(held) > 5500
    few = df.where("id < 40").select("id", *COLUMNS)
    assert {r.sample_rows for r in FO.fit_forest(few, COLUMNS, ["id"], 4, 128, weight=weight).collect()} == {20}


def test_jumps_make_the_draws_of_every_row_and_tree():
    """Under a bound, rows enter trees and are drawn as if every draw had been made and compared with it."""
    keys = np.random.default_rng(4).integers(0, 2**63, 20_000).astype(np.uint64)
    weights = np.where(np.arange(20_000) % 2 == 0, 1.0, 3.0)
    for bound, trees in ((0.05, 50), (0.5, 20), (np.inf, 5)):
        found = [np.concatenate(part) for part in zip(*FO.draws(keys, weights, bound, trees, 99))]
        rows, tree, draw = found
        assert len(set(zip(rows.tolist(), tree.tolist()))) == len(rows) and draw.max() <= bound
        for remainder, weight in ((0, 1.0), (1, 3.0)):
            mine = rows % 2 == remainder
            chance = -np.expm1(-weight * bound)
            assert mine.sum() / (10_000 * trees) == pytest.approx(chance, rel=0.03)
            per_tree = np.bincount(tree[mine], minlength=trees) / 10_000
            assert np.abs(per_tree - chance).max() < 6 * np.sqrt(0.25 / 10_000)
            middle = -np.log1p(-0.5 * chance) / weight
            assert np.mean(draw[mine] <= middle) == pytest.approx(0.5, abs=0.02)


def test_partial_samples_merge_to_the_least_draws():
    rng = np.random.default_rng(6)
    row_type = FO._row_type(2)
    rows, tree, draw = np.arange(30_000), rng.integers(0, 3, 30_000), rng.random(30_000)
    points = rng.random((30_000, 2)).astype(np.float32)
    blocks = []
    for part in np.array_split(rng.permutation(30_000), 4):
        partial = FO._PartialSamples(3, 50, row_type)
        for few in np.array_split(part, 9):
            partial.add(rows[few], tree[few], draw[few], points)
        taken = partial.take()
        assert all(len(b) <= 50 * row_type.itemsize for b in taken.block) and np.isfinite(partial.bounds).all()
        blocks += list(zip(taken.tree, taken.block))
    for t in range(3):
        merged = np.frombuffer(b"".join(b for n, b in blocks if n == t), row_type)
        assert np.sort(merged["draw"])[:50].tolist() == np.sort(draw[tree == t])[:50].tolist()


def test_blocks_give_the_same_scores(spark, planted):
    """A forest that does not fit one block is scored block by block."""
    nodes = FO.fit_forest(planted, COLUMNS, ["id"], 12, 64).persist()
    whole, parted = FO.load_forest(nodes, COLUMNS), FO.load_forest(nodes, COLUMNS, block_bytes=1_000)
    assert len(whole.blocks) == 1 and len(parted.blocks) > 3 and parted.expected == whole.expected
    assert [t for n in range(len(parted.blocks)) for t in range(parted.blocks[n][0], parted.blocks[n][1] + 1)] == list(range(12))
    one, none = FO.add_scores(planted, whole, "s")
    many, paths = FO.add_scores(planted, parted, "s")
    assert not none and len(paths) == 1 and many.columns == one.columns
    a, b = (np.array([r.s for r in f.orderBy("id").collect()]) for f in (one, many))
    assert np.abs(a - b).max() < 1e-9
    flags = [FO.score_forest(planted, FO.with_cut(f, 0.6)).agg(F.sum("if_flag")).first()[0] for f in (whole, parted)]
    assert flags[0] == flags[1] > 0
    with pytest.raises(ValueError):
        FO.forest_score(spark, parted)


def test_walk_agrees_with_a_plain_descent(spark, planted):
    forest = FO.load_forest(FO.fit_forest(planted, COLUMNS, ["id"], 5, 64), COLUMNS)
    points = np.random.default_rng(1).normal(size=(50, 3)).astype(np.float32)
    want = []
    for p in points:
        total, expected = 0.0, 0.0
        for rows, _, feature, value, child in forest.trees:
            node = 0
            while feature[node] >= 0:
                node = child[node] + (p[feature[node]] > value[node])
            total += value[node]
            expected += float(FO.average_path(rows))
        want.append(2.0 ** (-total / expected))
    assert 2.0 ** (-forest.block(0).paths(points) / forest.expected) == pytest.approx(want)


def test_average_path():
    assert FO.average_path([1, 2, 256]).tolist() == pytest.approx([0.0, 1.0, 10.244770920], rel=1e-9)


def plain_mcd(points, support, steps=60):
    """Concentration steps from the coordinate-wise centre, on one machine."""
    mean, cov = np.zeros(points.shape[1]), np.eye(points.shape[1])
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", points - mean, CO.pseudo_inverse(cov), points - mean)
        chosen = points[d <= np.percentile(d, 100 * support)]
        mean, cov = chosen.mean(axis=0), np.cov(chosen.T, bias=True)
    d = np.einsum("ij,jk,ik->i", points - mean, CO.pseudo_inverse(cov), points - mean)
    factor = np.median(d) / CO.chi_square_quantile(0.5, points.shape[1])
    chosen = points[d < CO.chi_square_quantile(0.975, points.shape[1]) * factor]
    return chosen.mean(axis=0), np.cov(chosen.T, bias=True)


def test_covariance_matches_a_plain_fit(spark, planted):
    model = CO.fit_covariance(planted, COLUMNS)
    points = planted.select(*COLUMNS).toPandas().to_numpy()
    mean, cov = plain_mcd(points, S.COVARIANCE_SUPPORT)
    assert model.location == pytest.approx(mean.tolist(), abs=0.05)
    assert np.allclose(np.linalg.inv(np.array(model.precision)), cov, atol=0.1)
    scored = CO.score_covariance(planted, model).collect()
    assert {r.id for r in scored if r.mah_distance > 100} == set(range(1000, 1020))
    want = np.einsum("ij,jk,ik->i", points - model.location, np.array(model.precision), points - model.location)
    assert [r.mah_distance for r in scored] == pytest.approx(want.tolist(), rel=1e-6)


def exact_step(points, mean, cov, support):
    """The centre and covariance of the closest rows, from sorted distances."""
    d = np.einsum("ij,jk,ik->i", points - mean, CO.pseudo_inverse(cov), points - mean)
    chosen = points[np.argsort(d, kind="stable")[: int(np.floor(support * (len(points) - 1))) + 1]]
    return chosen.mean(axis=0), np.cov(chosen.T, bias=True)


def test_a_concentration_step_is_exact(spark, planted):
    points = planted.select(*COLUMNS).toPandas().to_numpy()
    states = {0: (np.zeros(3), np.eye(3)), 4: (np.array([1.0, -1.0, 0.5]), np.array([[2.0, 0.3, 0.0], [0.3, 1.0, 0.1], [0.0, 0.1, 0.5]]))}
    shares = {0: 0.85, 4: 0.5}
    for partitions in (1, 7):
        df = planted.select(*COLUMNS).repartition(partitions)
        near = {}
        # The edge is not foreseen, foreseen, and foreseen wrongly.
        for _ in range(3):
            got = CO._advance(df, COLUMNS, states, shares, len(points), near)
            for s, state in states.items():
                mean, cov = exact_step(points, *state, shares[s])
                assert got[s][0] == pytest.approx(mean, abs=1e-12) and got[s][1] == pytest.approx(cov, abs=1e-10)
            if partitions == 7:
                near[0] = {-40}


def test_covariance_settles_where_every_row_is_weighed(spark, planted):
    """No start of many random ones ends tighter, and the fit does not depend on partitioning."""
    points = planted.select(*COLUMNS).toPandas().to_numpy()
    rng = np.random.default_rng(11)
    best = None
    for _ in range(60):
        some = points[rng.choice(len(points), 4, replace=False)]
        mean, cov = some.mean(axis=0), np.cov(some.T, bias=True)
        for _ in range(100):
            before = CO.log_volume(cov)
            mean, cov = exact_step(points, mean, cov, S.COVARIANCE_SUPPORT)
            if CO.log_volume(cov) == before:
                break
        best = min(best or CO.log_volume(cov), CO.log_volume(cov))
    names = ["x", "y", "z"]
    df = planted.select(*[F.col(c).alias(n) for c, n in zip(COLUMNS, names)])
    distributions = CO.coarse_distribution(df, names)
    _, cov = CO._settle(df, names, CO._starts(df, names, distributions), S.COVARIANCE_SUPPORT, len(points))
    assert CO.log_volume(cov)[1] <= best[1] + 1e-6
    one, two = (CO.fit_covariance(df, names) for df in (df, df.repartition(9)))
    assert one.location == pytest.approx(two.location, rel=1e-9) and one.threshold == pytest.approx(two.threshold, rel=1e-9)


def test_covariance_leaves_out_rows_with_gaps(spark, planted):
    holed = planted.select("id", *COLUMNS).unionByName(planted.limit(40).select("id", F.lit(None).cast("double").alias("a"), "b", F.lit(float("nan")).alias("c")))
    assert CO.fit_covariance(holed, COLUMNS).location == pytest.approx(CO.fit_covariance(planted, COLUMNS).location, rel=1e-9)


def test_a_fit_that_does_not_settle_is_an_error(spark, planted, monkeypatch):
    monkeypatch.setattr(CO, "MOST_STEPS", 3)
    monkeypatch.setattr(CO, "SETTLED", -1.0)
    with pytest.raises(RuntimeError):
        CO.fit_covariance(planted, COLUMNS)


def test_covariance_with_collinear_columns_is_finite(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 2))
    df = points_frame(spark, np.column_stack([x, x[:, 0] * 3 - x[:, 1]]))
    model = CO.fit_covariance(df, COLUMNS)
    assert np.isfinite(model.precision).all() and np.isfinite(model.threshold)
    assert np.linalg.matrix_rank(np.array(model.precision), tol=1e-6) == 2
    flagged = CO.score_covariance(df, model).agg(F.avg("mcd_flag")).first()[0]
    assert flagged <= 0.03


def test_covariance_distances_survive_rescaling(spark, planted):
    wide = planted.select("id", (F.col("a") * 10).alias("a"), (F.col("b") / 4).alias("b"), "c")
    one, two = (CO.fit_covariance(df, COLUMNS) for df in (planted, wide))
    a, b = ([r.mah_distance for r in CO.score_covariance(df, m).collect()] for df, m in ((planted, one), (wide, two)))
    assert np.corrcoef(a, b)[0, 1] > 0.999


def test_covariance_needs_spread_and_rows(spark):
    with pytest.raises(ValueError):
        CO.fit_covariance(points_frame(spark, [[1.0, 1.0, 1.0]] * 50), COLUMNS)
    with pytest.raises(ValueError):
        CO.fit_covariance(points_frame(spark, np.eye(3)), COLUMNS)


def test_chi_square_quantiles():
    assert CO.chi_square_quantile(0.5, 7) == pytest.approx(6.345811, abs=1e-5)
    assert CO.chi_square_quantile(0.975, 7) == pytest.approx(16.012764, abs=1e-5)


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    df = stream_features(samples.trips(spark, sf_dir)).persist()
    return df, *TR.train_ensemble(df, ["trip_id"], 0.03, trees=30, sample=64)


def test_ensemble_scores_and_votes(trained):
    df, _, model = trained
    modes = {m: TR.score_ensemble(df, model, m).agg(F.sum("is_anomaly")).first()[0] for m in ("strict", "union", "if_only")}
    assert modes["strict"] <= modes["if_only"] <= modes["union"]
    assert abs(modes["if_only"] / df.count() - 0.03) < 0.01


def test_model_without_covariance_votes_by_the_forest(trained):
    from dataclasses import replace

    df, _, model = trained
    scored = TR.score_ensemble(df, replace(model, covariance=None))
    assert scored.filter("is_anomaly <> if_flag OR mah_distance <> 0").isEmpty()


def test_model_store_round_trip(spark, trained, tmp_path):
    df, nodes, model = trained
    root = str(tmp_path)
    MO.save_model(spark, root, 3, nodes, model)
    MO.save_model(spark, root, 5, nodes, model)
    version, loaded = MO.latest_model(spark, root)
    assert version == 5 and MO.latest_model(spark, root, upto=4)[0] == 3
    assert loaded.scaler == model.scaler and loaded.covariance == model.covariance
    a, b = (TR.score_ensemble(df, m).orderBy("trip_id").select("if_score", "mah_distance").collect() for m in (model, loaded))
    assert a == b
    assert [r.version for r in MO.model_table(spark, root).collect()] == [3, 5]


def test_stale_and_broken_models_are_discarded(spark, trained, tmp_path):
    _, nodes, model = trained
    root = str(tmp_path)
    MO.save_model(spark, root, 1, nodes, model)
    assert MO.load_model(spark, root, 1, expected=S.MODEL_FEATURES[:-1]) is None
    assert not (tmp_path / "models/version=1").exists()
    MO.save_model(spark, root, 2, nodes, model)
    delete(spark, f"{root}/models/version=2/scaler")
    assert MO.latest_model(spark, root) is None
    MO.save_model(spark, root, 4, nodes, model)
    for part in (tmp_path / "models/version=4/forest").glob("*.parquet"):
        (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
        part.write_bytes(part.read_bytes()[: part.stat().st_size // 2])
    assert MO.load_model(spark, root, 4) is None and (tmp_path / "models/version=4/meta").exists()
    MO.save_model(spark, root, 3, nodes, model)
    assert MO.load_model(spark, root, 3, S.MODEL_FEATURES[:-1], own=False) is None
    assert MO.latest_model(spark, root)[0] == 3
    delete(spark, f"{root}/models/version=3/covariance")
    assert MO.load_model(spark, root, 3).covariance is None


def test_retrain_contamination(trained):
    df, _, model = trained
    assert TR.retrain_contamination(df, None) == 0.03
    rate = TR.score_ensemble(df, model).agg(F.avg("if_flag")).first()[0]
    assert TR.retrain_contamination(df, model) == pytest.approx(0.8 * 0.03 + 0.2 * rate)


def test_permutation_sensitivity_is_repeatable(spark, sf_dir, trained):
    _, _, model = trained
    normals, anomalies = samples.results(spark, sf_dir)
    one, two = (DI.permutation_sensitivity(normals, anomalies, model, ["trip_id"]).collect() for _ in range(2))
    assert one == two and len(one) == len(S.MODEL_FEATURES)
    assert max(r.relative for r in one) == pytest.approx(1.0, abs=1e-6)
    assert DI.permutation_sensitivity(normals.limit(5), anomalies.limit(5), model, ["trip_id"]).isEmpty()


def test_swapped_paths_equal_full_walks(planted):
    forest = FO.load_forest(FO.fit_forest(planted, COLUMNS, ["id"], 9, 64), COLUMNS)
    rng = np.random.default_rng(2)
    points, donors = (rng.normal(size=(300, 3)).astype(np.float32) for _ in range(2))
    block = forest.block(0)
    totals = block.swapped_paths(points, donors)
    assert totals[0] == pytest.approx(block.paths(points), abs=1e-6)
    for i in range(3):
        swapped = points.copy()
        swapped[:, i] = donors[:, i]
        assert totals[i + 1] == pytest.approx(block.paths(swapped), abs=1e-4)


def test_permutation_sensitivity_equals_full_rescoring(spark, sf_dir, trained):
    """All rows scored once as they are and once with each feature exchanged."""
    _, _, model = trained
    normals, anomalies = samples.results(spark, sf_dir)
    got = {r.feature: r.importance for r in DI.permutation_sensitivity(normals, anomalies, model, ["trip_id"], bucket_rows=150).collect()}
    features = model.forest.columns
    both = normals.select("*").unionByName(anomalies.select(*normals.columns))
    scaled = TR.scale(both, model.scaler).select(F.xxhash64("trip_id").alias("_id"), *[F.col(c).cast("float") for c in features])
    total = scaled.count()
    buckets = -(-total // 150)
    rows = scaled.withColumn("b", F.pmod(F.xxhash64("_id", F.lit(S.SEED)), F.lit(buckets))).toPandas()
    flagged = np.zeros(len(features) + 1)
    for b, part in rows.groupby("b"):
        points = part.sort_values(["_id", *features])[features].to_numpy(np.float32)
        for i in range(-1, len(features)):
            swapped = points.copy()
            if i >= 0:
                swapped[:, i] = points[DI.bucket_permutation(len(points), int(b), i, S.SEED), i]
            flagged[i + 1] += (2.0 ** (-model.forest.block(0).paths(swapped) / model.forest.expected) > model.forest.cut).sum()
    assert buckets > 3
    for i, c in enumerate(features):
        assert got[c] == pytest.approx(abs(flagged[i + 1] - flagged[0]) / total, abs=1.5 / total)


def test_swapped_paths_walk_a_row_alone_only_after_it_turns(monkeypatch):
    """A row's own steps begin where a donor value turns the other way, so they are few beside a walk per compared feature."""
    rng = np.random.default_rng(3)
    points = rng.lognormal(size=(4000, 14)).astype(np.float32)
    donors = np.column_stack([rng.permutation(points[:, j]) for j in range(14)])
    block = FO.Block([(256, *FO._grow(points[rng.integers(0, 4000, 256)], 8, np.random.default_rng(t))) for t in range(10)])
    read, steps = FO._Step.read, []
    monkeypatch.setattr(FO._Step, "read", lambda self, word, bits, at: steps.append(len(at)) or read(self, word, bits, at))
    totals = block.swapped_paths(points, donors)
    assert sum(steps) < 2 * len(points) * sum(tree[1] for tree in block.trees)
    for feature in range(14):
        swapped = points.copy()
        swapped[:, feature] = donors[:, feature]
        assert np.allclose(totals[feature + 1], block.paths(swapped))


def test_growing_and_packing_sort_no_wide_numbers(monkeypatch):
    """Rows move to their children by counts, and draws go to their trees by a radix sort, which numpy has for 16 bits."""
    rng = np.random.default_rng(5)
    points = rng.lognormal(size=(3000, 4)).astype(np.float32)
    plain, wide = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda a, *args, **kw: (a.dtype.kind in "iu" and a.itemsize > 2 and wide.append(len(a))) or plain(a, *args, **kw))
    depth, feature, value, child = FO._grow(points, 12, np.random.default_rng(1))
    partial = FO._PartialSamples(20, 50, FO._row_type(4))
    partial.add(np.arange(3000), rng.integers(0, 20, 3000), rng.random(3000), points)
    assert not wide
    # Every node holds the rows that its cut sends there.
    at, rows = {0: np.arange(3000)}, 0
    for node in range(len(feature)):
        mine = at[node]
        if feature[node] >= 0:
            over = points[mine, feature[node]] > value[node]
            at[int(child[node])], at[int(child[node]) + 1] = mine[~over], mine[over]
            assert over.any() and not over.all()
        else:
            rows += len(mine)
    assert rows == 3000
    assert sum(partial.sizes.values()) == 3000


def test_moments_sort_classes_by_radix_in_stable_order(monkeypatch):
    rng = np.random.default_rng(4)
    plain, kinds = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda a, *args, **kw: kinds.append(a.dtype.itemsize) or plain(a, *args, **kw))
    for spread, widths in ((3, {2}), (500 * CO.PARTS_OF_CLASS, {2}), (1 << 40, {8})):
        kinds.clear()
        classes = rng.integers(-spread, spread, 4000)
        order, found, first = CO._in_order(classes)
        assert set(kinds) == widths
        assert (order == plain(classes, kind="stable")).all()
        assert found == sorted(set(classes.tolist())) and (classes[order][first] == found).all()
    points = rng.normal(size=(50, 3))
    i, j = np.triu_indices(3)
    assert (CO._products(points) == np.hstack([np.ones((50, 1)), points, points[:, i] * points[:, j]])).all()
