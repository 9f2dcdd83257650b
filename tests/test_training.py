from pyspark.sql import functions as F

from loanloom import session
from loanloom.operators import models
from loanloom.plans.bank import Bank
from loanloom.session import materialise


def test_wide_rows_are_written_once(spark, sf, monkeypatch):
    matrix, written = Bank.of(spark, sf).matrix(), []

    def counted(df, *rest):
        written.append(len(df.columns))
        return materialise(df, *rest)

    monkeypatch.setattr(models, "materialise", counted)
    data, inputs = models.training_set(matrix)
    assert [n for n in written if n > 2] == [len(data.columns)]
    # The same rows as split, weighted and folded one after the other.
    table, _ = models.prepare(matrix, inputs)
    split = models.stratified_split(table)
    train = models.stratified_folds(models.with_class_weight(split.where("split = 'train'")))
    test = split.where("split = 'test'").withColumns({models.WEIGHT: F.lit(1.0), "fold": F.lit(-1)})
    told = train.unionByName(test).select(*data.columns)
    assert data.exceptAll(told).isEmpty() and told.exceptAll(data).isEmpty()


def test_a_fit_keeps_its_vectors_while_it_runs(spark, sf, monkeypatch):
    data, inputs = Bank.of(spark, sf).training()
    train = data.where("split = 'train'")
    pipeline = models.estimators(inputs, train.count())[models.LOGISTIC]
    found, told = models.fit(pipeline, train).stages[-1], pipeline.fit(train).stages[-1]
    # The same model but for the order in which parts are added up, which moves the end of the descent a little.
    assert all(abs(a - b) < 1e-2 * max(1, abs(b)) for a, b in zip(found.coefficients.toArray(), told.coefficients.toArray()))
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_stages_over_wide_rows_keep_to_methods_the_jvm_compiles(spark, sf):
    Bank(spark, sf)
    assert int(spark.conf.get(session.METHOD_LIMIT)) <= 8000


def test_folds_share_one_kept_copy_of_the_vectors(spark, sf, monkeypatch):
    data, inputs = Bank.of(spark, sf).training()
    met = []
    monkeypatch.setattr(models, "fold_auc", lambda pipeline, train, fold: met.append((train, train.is_cached)) or 0.5)
    models.compare(data, inputs, [models.LOGISTIC], fitted=lambda n: Bank.of(spark, sf).trained(n))
    assert len(met) == models.FOLDS and len({id(train) for train, _ in met}) == 1
    assert all(kept and set(train.columns) == {models.LABEL, models.WEIGHT, "fold", "features"} for train, kept in met)
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_a_fold_is_the_same_from_columns_and_from_vectors(spark, sf):
    data, inputs = Bank.of(spark, sf).training()
    train = data.where("split = 'train'")
    for name in (models.LOGISTIC, models.FOREST):
        pipeline = models.estimators(inputs, train.count())[name]
        shared = models.vectors_of(pipeline, train, ["fold"])
        assert abs(models.fold_auc(pipeline, shared, 1) - models.fold_auc(pipeline, train, 1)) < 1e-9


def test_rows_keep_their_places_in_a_forest_that_stays_the_same(spark, sf):
    data, inputs = Bank.of(spark, sf).training()
    train = data.where("split = 'train'")
    pipeline = models.estimators(inputs, train.count())[models.FOREST]
    walking = pipeline.copy()
    assert pipeline.getStages()[-1].getCacheNodeIds()
    walking.setStages([pipeline.getStages()[0], pipeline.getStages()[-1].copy().setCacheNodeIds(False)])
    one, other = (models.fit(p, train).stages[-1] for p in (pipeline, walking))
    assert one.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_fewer_fits_of_large_tables_run_at_a_time():
    assert models.side_by_side(10_000) == models.FITS and models.side_by_side(10_000, 3) == 3
    assert models.side_by_side(720_000) == 4 and models.side_by_side(10 ** 8) == 1
