"""The registered training queries search the grids of the reference."""

from unittest.mock import MagicMock

from shopgrain.plans import model_queries, models

BOOSTED = {"maxIter": [100, 200], "maxDepth": [3, 4], "stepSize": [0.05, 0.1]}


def test_registered_queries_search_the_full_grids(monkeypatch):
    seen = {}

    def search(name, default):
        def train(features, grid=default):
            seen[name] = grid
            return MagicMock()

        monkeypatch.setattr(models, name, train)

    search("train_churn", models.BOOSTED_GRID)
    search("train_ltv", models.BOOSTED_GRID)
    search("train_demand", models.FOREST_GRID)
    for name in ("customer_features", "product_features"):
        monkeypatch.setattr(model_queries, name, MagicMock())
    monkeypatch.setattr(models, "metrics_frame", MagicMock())
    monkeypatch.setattr(models, "run_ml", lambda spark, jobs: (MagicMock(), []))
    both = {}

    def all_models(customers, products, boosted=models.BOOSTED_GRID, forest=models.FOREST_GRID):
        both.update(boosted=boosted, forest=forest)

    monkeypatch.setattr(models, "all_models", all_models)
    queries = model_queries.ModelQueries("2001-08-02", ()).named()
    for name in ("train_churn", "train_ltv", "train_demand", "run_ml"):
        queries[name](MagicMock(), MagicMock())
    assert seen["train_churn"] == seen["train_ltv"] == both["boosted"] == BOOSTED
    assert seen["train_demand"] == both["forest"] == models.FOREST_GRID
    assert models.FOREST_GRID["numTrees"] == [100, 200] and len(models.FOREST_GRID["maxDepth"]) == 2
