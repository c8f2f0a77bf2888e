from daymark.ml.params import DEFAULT_PARAMS, SEARCH_SPACE, trials
from daymark.schema import HORIZONS
from daymark.suite import models
from tests.conftest import SF


def test_whole_parameters_and_all_horizons(spark, monkeypatch):
    seen = []

    def search(split, features, table):
        seen.append((table, {r.horizon for r in split.select("horizon").distinct().collect()}, features))
        return {h: [{"trial": i, "params": p, "val_mae": 1.0, "n_trees": p["n_estimators"], "error": None} for i, p in enumerate(table)] for h in HORIZONS}

    monkeypatch.setattr(models, "search_all", search)
    found = models.search(spark, SF).collect()
    assert seen == [(trials(models.TRIALS, space=SEARCH_SPACE), set(HORIZONS), models.FEATURES)]
    assert len(found) == 7 * models.TRIALS and models.TRIALS >= 30
    monkeypatch.setattr(models, "_trained", {})
    monkeypatch.setattr(models, "train_all", lambda *args, table, **more: table)
    assert models.trained(spark, SF) == [DEFAULT_PARAMS]


def test_trials_that_better_ones_stopped_are_sound(spark, monkeypatch):
    """The best trial may have few trees; those it outlived may have got more. Others that stopped early are not sound."""
    table = trials(models.TRIALS, space=SEARCH_SPACE)

    def search(split, features, table):
        rows = [{"trial": i, "params": p, "val_mae": 2.0, "n_trees": 16, "stopped_by": 1.5, "error": None} for i, p in enumerate(table)]
        best, later, unreached, alone = rows[13], rows[0], rows[1], rows[2]
        best.update(val_mae=1.0, n_trees=50, stopped_by=None)
        later.update(n_trees=256)
        unreached.update(stopped_by=None)
        alone.update(stopped_by=2.5)
        return {1: [best, *(r for r in rows if r is not best)]}

    assert table[13]["n_estimators"] == 50 and table[0]["n_estimators"] > 256
    monkeypatch.setattr(models, "search_all", search)
    sound = {r.trial: r.sound for r in models.search(spark, SF).collect()}
    assert {i for i, s in sound.items() if not s} == {1, 2}
