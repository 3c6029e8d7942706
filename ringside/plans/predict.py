"""Train and store the models, score an upcoming card with them, keep the ledger."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringside.columns import STACK_COLS
from ringside.functions.scores import Eras
from ringside.operators import card, history, ledger
from ringside.plans import learn
from ringside.plans.build import Store
from ringside.session import cut


def slices(train: DataFrame, eras: Eras) -> list[DataFrame]:
    out = [eras.slice(train, e) for e in ("FIT", "VAL", "TEST")]
    if any(s.isEmpty() for s in out):
        raise ValueError("a time slice is empty; check the era dates")
    return out


def stacked_slices(parts, models, recipes, boost) -> list[DataFrame]:
    """FIT gets out-of-fold predictions, VAL and TEST those of the production models."""
    fit, val, test = parts
    preds = [learn.out_of_fold(fit, recipes, boost)]
    preds += [learn.stat_predictions(models, part) for part in (val, test)]
    return [cut(learn.with_stack(part, p), "stacked") for part, p in zip(parts, preds)]


def train(store: Store, eras: Eras = Eras(), boost: learn.Boost = learn.Boost()) -> dict[str, dict]:
    """Three stat models, then the winner model on their stacked predictions; all stored."""
    rows = store.read("fight_model_train")
    recipes = {r: learn.feature_columns(rows.columns, r) for r in ("win", "all")}
    fit, val, test = parts = slices(rows, eras)
    models, metrics = {}, {}
    for name, (label, base, recipe) in learn.STAT_TARGETS.items():
        models[name], errors = learn.stat_scores(fit, val, test, recipes[recipe], label, base, boost)
        metrics[name] = errors.first().asDict()
    win_cols = recipes["win"] + STACK_COLS
    win, result = learn.win_models(*stacked_slices(parts, models, recipes, boost), win_cols, boost)
    metrics["win"] = result.first().asDict()
    for name, model in (models | {"win": win}).items():
        model.metrics = metrics[name]
        learn.save(model, store.path(f"models/{name}"))
    learn.save_run(store.spark, store.path("models"), eras, boost, recipes | {"win_stacked": win_cols})
    return metrics


def ablation(store: Store, eras: Eras = Eras(), boost: learn.Boost = learn.Boost()) -> DataFrame:
    """Leave one family out; written as CSV next to the models."""
    rows = store.read("fight_model_train")
    recipes = {r: learn.feature_columns(rows.columns, r) for r in ("win", "all")}
    models = {n: learn.load(store.spark, store.path(f"models/{n}")) for n in learn.STAT_TARGETS}
    stacked = stacked_slices(slices(rows, eras), models, recipes, boost)
    results = learn.ablate(
        store.spark, *stacked, learn.ablation_recipes(recipes["win"] + STACK_COLS, recipes["all"]), boost)
    results.coalesce(1).write.mode("overwrite").option("header", True).csv(store.path("models/ablation"))
    return results


def read_ablation(spark, path: str) -> DataFrame:
    """An ablation CSV whose header may carry blanks; numbers parsed, the recipe kept as text."""
    raw = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).csv(path)
    trimmed = raw.toDF(*[c.strip() for c in raw.columns])
    ints = [c for c in trimmed.columns if c in ("n_features", "trees") or "_n" in c]
    return trimmed.select(*[
        F.col(c) if c == "recipe" else F.col(c).try_cast("int" if c in ints else "double").alias(c)
        for c in trimmed.columns
    ])


def score_card(store: Store, bouts: DataFrame, event_date: Column, bio: DataFrame) -> DataFrame:
    """Both-ways averaged win probability and expected stats of every upcoming bout."""
    models = {n: learn.load(store.spark, store.path(f"models/{n}")) for n in [*learn.STAT_TARGETS, "win"]}
    named = cut(card.resolve_card(bouts, store.read("fighters")), "card")
    past = history.load_history(store.read("fighter_fight_facts"))
    upcoming = cut(card.card_features(past, named, event_date), "card-features")  # read for either corner
    rows = cut(card.card_rows(upcoming, named, bio), "card-rows")
    win = models.pop("win")
    stats = learn.stat_predictions(models, rows)
    scored = win.predict(learn.with_stack(rows, stats)).select(*learn.KEYS, "p").join(stats, learn.KEYS)
    return named.join(card.symmetric(scored), "fight_id")


def update_ledger(store: Store, predictions: DataFrame, now: Column) -> DataFrame:
    """Score, log, score again; the stored ledger moves on and its summary comes back."""
    done = ledger.completed_fights(store.read("fights"), store.read("events"), store.read("fighters"))
    old = store.read("card_picks") if store.exists("card_picks") else store.spark.createDataFrame(
        [], ledger.LEDGER_SCHEMA)
    new, totals = ledger.run_cycle(old, predictions, done, now)
    store.replace("card_picks", new)
    return totals
