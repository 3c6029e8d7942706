"""Boosted-tree models over the training rows: encoding, fitting, walk-forward stacking, ablation.

Rows are encoded once, into one vector with a named slot per feature. A recipe is a
slice of that vector, a fold or an era a filter of the rows, so fits share what they
read and several run side by side. Spark's trees know no missing values: a gap is a
value below all others, which a split can set apart. Nothing of the encoding is
learnt from values, so no fold sees another's. Losses will differ from other boosting
libraries; the protocol (time slices, weights, out-of-fold stack) is the same.
"""

import json
import re
from calendar import monthrange
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field, replace
from datetime import date

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ringside.columns import STACK_COLS, STACK_NAMES, WIN_RECIPE_EXCLUDES
from ringside.functions import scores
from ringside.session import cut

# What is no feature, and when a walk-forward year can be fitted.
NOT_FEATURES = ["fight_id", "event_date", "orientation", "a_fighter_id", "b_fighter_id"]
MIN_TRAIN_ROWS, MIN_INNER_FIT, MIN_INNER_VAL = 250, 200, 50
FIXED_TREES = 150
INNER_VAL_MONTHS = 6
MIN_VETERAN_FIT, MIN_VETERAN_VAL = 200, 50
PATIENCE = 40
#: Trees grown before the validation loss is looked at for the first time; twice as many each further time.
FIRST_TREES = 64
#: What stands for a gap.
MISSING = -1e9
#: Fits that run side by side.
FITS_AT_ONCE = 4
KEYS = ["fight_id", "orientation"]
STAT_TARGETS = {
    "slpm": ("y_a_sig_str_landed_pm", "a_career_sig_str_landed_pm_avg", "win"),
    "td": ("y_a_td_landed", "a_career_td_landed_avg", "all"),
    "ctrl": ("y_a_ctrl_seconds", "a_career_ctrl_seconds_avg", "all"),
}


@dataclass(frozen=True)
class Boost:
    trees: int = 500
    depth: int = 5
    step: float = 0.05
    subsample: float = 0.85
    columns: str = "0.5"
    min_rows: int = 12
    seed: int = 42


def feature_columns(columns: list[str], recipe: str = "all") -> list[str]:
    cols = [c for c in columns if c not in NOT_FEATURES and not c.startswith("y_")]
    if recipe == "win":
        cols = [c for c in cols if not any(part in c for part in WIN_RECIPE_EXCLUDES)]
    return cols


# -- encoding ---------------------------------------------------------------


def categories(rows: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted values of each text column; they are part of the model, one code each."""
    out = {}
    for name, kind in rows.select(*[c for c in cols if c in rows.columns]).dtypes:
        if kind == "string":
            found = rows.select(name).filter(F.col(name).isNotNull()).distinct().collect()
            out[name] = sorted(r[0] for r in found)
    return out


def encode(rows: DataFrame, cols: list[str], codes: dict[str, list[str]]) -> Column:
    """All features as one vector: codes for text, MISSING for gaps, for values and for columns not seen when fitting."""
    out = []
    for c in cols:
        if c not in rows.columns:
            value = F.lit(None).cast("double")
        elif c in codes:
            # one literal array, whatever the number of values; 0 means not there
            place = F.array_position(F.lit(codes[c]).cast("array<string>"), F.col(c))
            value = F.when(place > 0, (place - 1).cast("double"))
        else:
            value = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        out.append(F.coalesce(value, F.lit(MISSING)))
    return array_to_vector(F.array(*out))


@dataclass
class Matrix:
    """Rows encoded once for any number of fits: keys, labels, weight, and the slots of all features in one vector."""

    rows: DataFrame
    slots: list[str]
    codes: dict[str, list[str]]

    @classmethod
    def of(cls, rows: DataFrame, cols: Iterable[str], keep: Iterable[str]) -> "Matrix":
        """cols may name columns that the rows do not have; these are no features. keep: labels and what slices need."""
        slots = [c for c in dict.fromkeys(cols) if c in rows.columns]
        codes = categories(rows, slots)
        kept = [c for c in dict.fromkeys([*KEYS, "event_date", *keep]) if c in rows.columns]
        coded = rows.select(*kept, scores.sample_weight(rows).alias("weight"), scores.both_veterans(rows).alias("veterans"),
                            encode(rows, slots, codes).alias("slots"))
        return cls(cut(coded, "matrix"), slots, codes)

    def where(self, cond: Column | str) -> "Matrix":
        return replace(self, rows=self.rows.filter(cond))

    def sliced(self, cols: list[str]) -> DataFrame:
        """The rows with the features of a recipe, in its order."""
        places = [self.slots.index(c) for c in cols]
        return VectorSlicer(inputCol="slots", outputCol="features", indices=places).transform(self.rows).drop("slots")


@dataclass
class Model:
    kind: str
    label: str
    features: list[str]
    codes: dict[str, list[str]]
    stages: PipelineModel
    metrics: dict = field(default_factory=dict)

    @property
    def trees(self) -> int:
        return self.stages.stages[-1].getNumTrees

    def predict(self, rows: "DataFrame | Matrix", name: str = "p") -> DataFrame:
        """The rows with the prediction: P(A wins), or the predicted stat."""
        if isinstance(rows, Matrix):
            coded = rows.sliced(self.features)
        else:
            coded = rows.withColumn("features", encode(rows, self.features, self.codes))
        done = self.stages.transform(coded)
        out = vector_to_array("probability")[1] if self.kind == "win" else F.col("prediction")
        made = (set(done.columns) - set(coded.columns)) | {"features"}
        return done.withColumn(name, out).drop(*[c for c in made if c != name])


def fit(train: "DataFrame | Matrix", cols, label, boost: Boost, val: "DataFrame | Matrix | None" = None, kind: str = "stat") -> Model:
    """One weighted boosted model.

    With ``val``, the validation loss after each tree is worked out (log loss, or
    absolute error of a stat), and the model keeps as many trees as give the least
    loss before it fails to fall for PATIENCE trees. No trees are grown far beyond
    that end: the same seed grows the same first trees, so a fit of fewer trees that
    reaches it says what the fit of all would.
    train and val are slices of one matrix, or rows that are encoded first.
    """
    if not isinstance(train, Matrix):
        train, val = _encoded([train, val], cols, [label])
    used = [c for c in cols if c in train.slots]

    def ready(part: Matrix) -> DataFrame:
        return part.where(F.col(label).isNotNull()).sliced(used).select(label, "weight", "features")

    common = dict(
        featuresCol="features", labelCol=label, weightCol="weight", maxIter=boost.trees, maxDepth=boost.depth,
        stepSize=boost.step, subsamplingRate=boost.subsample, featureSubsetStrategy=boost.columns,
        minInstancesPerNode=boost.min_rows, seed=boost.seed,
    )
    tree = GBTClassifier(**common) if kind == "win" else GBTRegressor(**common)
    if val is None:
        model = tree.fit(ready(train))
    else:
        exam, grown = ready(val), min(boost.trees, FIRST_TREES)
        while True:
            model = tree.copy({tree.maxIter: grown}).fit(ready(train))
            losses = model.evaluateEachIteration(exam) if kind == "win" else model.evaluateEachIteration(exam, "absolute")
            kept = trees_to_keep(losses)
            if grown == boost.trees or grown - kept >= PATIENCE:
                break
            grown = min(boost.trees, 2 * grown)
        if kept < grown:
            model = tree.copy({tree.maxIter: kept}).fit(ready(train))
    return Model(kind, label, used, {c: v for c, v in train.codes.items() if c in used}, PipelineModel([model]))


def _encoded(parts: list[DataFrame | None], cols: Iterable[str], keep: Iterable[str]) -> list[Matrix | None]:
    """The parts as slices of one matrix."""
    named = [p.withColumn("part", F.lit(i)) for i, p in enumerate(parts) if p is not None]
    every = named[0]
    for p in named[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    matrix = Matrix.of(every, cols, [*keep, "part"])
    return [None if p is None else matrix.where(F.col("part") == i) for i, p in enumerate(parts)]


def side_by_side(work: list[Callable]) -> list:
    """Results of independent pieces of work, some of them at a time; each is a chain of Spark jobs."""
    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        return list(pool.map(lambda f: f(), work))


def trees_to_keep(losses: list[float], patience: int = PATIENCE) -> int:
    """How many trees reach the least loss before ``patience`` trees in a row bring no lower one."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


# -- models of one stat, and of the winner ----------------------------------


def stat_scores(fit_rows, val, test, cols, label, base, boost: Boost) -> tuple[Model, DataFrame]:
    """A stat model and its error on test page rows, next to the career average."""
    model = fit(fit_rows, cols, label, boost, val=val)
    fill = scores.exact_percentile(fit_rows, F.col(label), 0.5) or 0.0
    page = scores.page_only(test)
    errors = scores.absolute_error(model.predict(page, "guess"), "guess", label, base, fill)
    return model, errors.withColumn("trees", F.lit(model.trees))


def win_models(fit_rows, val, test, cols, boost: Boost) -> tuple[Model, DataFrame]:
    """The winner model with its scores, and the same fitted on veterans only where they suffice."""
    fit_all, val_all = _encoded([fit_rows, val], cols, ["y_a_win"])
    model = fit(fit_all, cols, "y_a_win", boost, val=val_all, kind="win")
    page = scores.page_only(test)
    result = scores.win_baselines(model.predict(page)).withColumn("trees", F.lit(model.trees))
    old_fit, old_val = (m.where("veterans and y_a_win is not null") for m in (fit_all, val_all))
    if old_fit.rows.count() >= MIN_VETERAN_FIT and old_val.rows.count() >= MIN_VETERAN_VAL:
        veteran = fit(old_fit, cols, "y_a_win", boost, val=old_val, kind="win")
        exam = scores.win_scores(veteran.predict(page.filter(scores.both_veterans(page)))).first()
        result = result.withColumns(
            {"veteran_trained_logloss": F.lit(exam["logloss"]), "veteran_trained_acc": F.lit(exam["acc"])}
        )
    return model, result


# -- stacking ---------------------------------------------------------------


@dataclass(frozen=True)
class Fold:
    """How one calendar year is predicted: from what, and with an inner validation slice or a fixed number of trees."""

    year: int
    rows: int
    edge: date | None = None
    inner_fit: int = 0
    inner_val: int = 0

    @property
    def mode(self) -> str:
        if self.rows < MIN_TRAIN_ROWS:
            return "none"
        return "fixed" if self.inner_fit < MIN_INNER_FIT or self.inner_val < MIN_INNER_VAL else "stopped"


def fold_plan(rows: DataFrame, label: str) -> list[Fold]:
    """One fold per calendar year of the rows, from the labelled rows of the years before it.

    Worked out from the rows counted by day, a table as long as the calendar.
    """
    days = rows.groupBy("event_date").agg(F.count(label).alias("n")).filter("event_date is not null").collect()
    out = []
    for year in sorted({r["event_date"].year for r in days}):
        before = [r for r in days if r["event_date"].year < year and r["n"]]
        n = sum(r["n"] for r in before)
        if not n:
            out.append(Fold(year, 0))
            continue
        edge = _months_before(max(r["event_date"] for r in before), INNER_VAL_MONTHS)
        early = sum(r["n"] for r in before if r["event_date"] < edge)
        out.append(Fold(year, n, edge, early, n - early))
    return out


def _months_before(day: date, months: int) -> date:
    """The same day of an earlier month, or that month's last day."""
    years, month = divmod(day.year * 12 + day.month - 1 - months, 12)
    return date(years, month + 1, min(day.day, monthrange(years, month + 1)[1]))


def walk_forward(rows: "DataFrame | Matrix", cols, label, boost: Boost) -> DataFrame:
    """Out-of-fold predictions: a year is predicted by a model of the years before it.

    Rows of years with too little history keep a NULL. The folds share one matrix
    and are fitted side by side; every fit and prediction is a Spark job.
    """
    matrix = rows if isinstance(rows, Matrix) else Matrix.of(rows, cols, [label])
    year, known = F.year("event_date"), F.col(label).isNotNull()
    nothing = [*KEYS, F.lit(None).cast("double").alias("pred")]

    def predicted(fold: Fold) -> DataFrame:
        target = matrix.where(year == fold.year)
        if fold.mode == "none":
            return target.rows.select(*nothing)
        usable = matrix.where((year < fold.year) & known)
        if fold.mode == "fixed":
            model = fit(usable, cols, label, replace(boost, trees=min(boost.trees, FIXED_TREES)))
        else:
            early = F.col("event_date") < F.lit(fold.edge)
            model = fit(usable.where(early), cols, label, boost, val=usable.where(~early))
        return model.predict(target, "pred").select(*KEYS, "pred")

    result = matrix.rows.filter(year.isNull()).select(*nothing)
    for part in side_by_side([lambda f=f: predicted(f) for f in fold_plan(matrix.rows, label)]):
        result = result.unionByName(part)
    return cut(result, "walk-forward")


def with_stack(rows: DataFrame, preds: DataFrame) -> DataFrame:
    """Predicted stats of slot A, of slot B (the mirrored row's slot A), and their difference.

    ``preds``: fight_id, orientation and one column per stat name.
    """
    one = preds.dropDuplicates(KEYS)
    mine = one.select(*KEYS, *[F.col(n).alias(f"stack_a_{n}") for n in STACK_NAMES])
    turned = F.when(F.col("orientation") == "page", "swapped").otherwise("page").alias("orientation")
    theirs = one.select("fight_id", turned, *[F.col(n).alias(f"stack_b_{n}") for n in STACK_NAMES])
    both = rows.join(mine, KEYS, "left").join(theirs, KEYS, "left")
    diffs = {f"stack_diff_{n}": F.col(f"stack_a_{n}") - F.col(f"stack_b_{n}") for n in STACK_NAMES}
    return both.withColumns(diffs).select(*rows.columns, *STACK_COLS)


def stat_predictions(models: dict[str, Model], rows: DataFrame) -> DataFrame:
    """Production predictions of every stat, one narrow table."""
    out = rows
    for name, model in models.items():
        out = model.predict(out, f"pred_{name}")
    return out.select(*KEYS, *[F.col(f"pred_{n}").alias(n) for n in models])


def out_of_fold(rows: DataFrame, recipes: dict[str, list[str]], boost: Boost) -> DataFrame:
    """Walk-forward predictions of every stat, from one matrix."""
    matrix = Matrix.of(rows, [c for cols in recipes.values() for c in cols], [label for label, *_ in STAT_TARGETS.values()])
    out = rows.select(*KEYS)
    for name, (label, _, recipe) in STAT_TARGETS.items():
        preds = walk_forward(matrix, recipes[recipe], label, boost).withColumnRenamed("pred", name)
        out = out.join(preds, KEYS, "left")
    return out


# -- ablation ---------------------------------------------------------------


SLOT_PREFIXES = ("a_", "b_", "diff_")


@dataclass(frozen=True)
class Family:
    """Columns described by their name behind the slot prefix: how it begins, what it holds, or what it is."""

    begins: tuple[str, ...] = ()
    holds: tuple[str, ...] = ()
    names: tuple[str, ...] = ()
    prefixed: bool = True  # False: the whole name counts

    def pattern(self) -> re.Pattern:
        ways = [re.escape(x) for x in self.begins]
        ways += [f".*{re.escape(x)}" for x in self.holds]
        ways += [f"{re.escape(x)}$" for x in self.names]
        slot = f"(?:{'|'.join(SLOT_PREFIXES)})?" if self.prefixed else ""
        return re.compile(f"{slot}(?:{'|'.join(ways)})")


# The families that an ablation drops.
FAMILIES = {
    "last3": Family(begins=("last3_", "last_3_"), holds=("trend_last3_vs",)),
    "momentum": Family(begins=("momentum_",), names=("fights_in_last_18mo", "used_career_fallback_momentum")),
    "cardio": Family(holds=("cardio", "late_td", "late_kd", "late_ctrl", "n_r3", "n_distance", "n_five_stoppage",
                            "n_observed")),
    "last5": Family(begins=("last5_", "last_5_"), holds=("trend_last5_vs",)),
    "stack": Family(begins=("stack_",), prefixed=False),
    "opp_sos": Family(holds=("opp_asof", "avg_opp", "n_opp_known")),
    "bio": Family(names=("height", "reach", "ape_index")),
}
TD_PRODUCTS = ["prod_expected_td", "prod_last5_expected_td", "prod_ground_x_td"]


def without(cols: list[str], *families: str) -> list[str]:
    patterns = [FAMILIES[f].pattern() for f in families]
    return [c for c in cols if not any(p.match(c) for p in patterns)]


def ablation_recipes(base: list[str], every: list[str]) -> dict[str, list[str]]:
    """The baseline, one drop per family that has columns, one double drop and one addition."""
    out = {"baseline": base}
    for name in FAMILIES:
        kept = without(base, name)
        if len(kept) < len(base):
            out[f"drop_{name}"] = kept
    both = without(base, "last3", "momentum")
    out[f"drop_last3+momentum ({len(base) - len(both)} gone)"] = both
    extra = [c for c in every if any(p in c for p in TD_PRODUCTS)]
    out[f"add_td_products (+{len(extra)})"] = base + [c for c in extra if c not in base]
    return out


def ablate(spark: SparkSession, fit_rows, val, test, recipes: dict[str, list[str]], boost: Boost) -> DataFrame:
    """One row per recipe with its validation and test scores; delta against the first recipe.

    All recipes are slices of one matrix and are fitted side by side.
    """
    names = ["n", "logloss", "acc", "n_conf", "acc_conf", "n_66", "acc_66"]
    fit_all, val_all, test_all = _encoded([fit_rows, val, test], [c for cols in recipes.values() for c in cols], ["y_a_win"])

    def scored(recipe: str, cols: list[str]) -> tuple:
        model = fit(fit_all, cols, "y_a_win", boost, val=val_all, kind="win")
        v, t = (scores.win_scores(model.predict(s)).first() for s in (val_all, test_all))
        return recipe, len(cols), model.trees, *[v[n] for n in names], *[t[n] for n in names]

    rows = side_by_side([lambda r=r, c=c: scored(r, c) for r, c in recipes.items()])
    at = 3 + names.index("logloss")
    rows = [(*r, r[at] - rows[0][at]) for r in rows]
    kinds = {"n": "long", "n_conf": "long", "n_66": "long"}
    schema = "recipe string, n_features int, trees int, " + ", ".join(
        f"{era}_{n} {kinds.get(n, 'double')}" for era in ("val", "test") for n in names
    ) + ", delta_val_logloss double"
    return spark.createDataFrame(rows, schema)


# -- storage ----------------------------------------------------------------


def save(model: Model, path: str) -> None:
    """The fitted stages and one JSON row that says how to feed them."""
    model.stages.write().overwrite().save(f"{path}/stages")
    meta = {k: v for k, v in model.__dict__.items() if k != "stages"} | {"trees": model.trees}
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta, default=str),)], "meta string").coalesce(1).write.mode(
        "overwrite"
    ).text(f"{path}/meta")


def load(spark: SparkSession, path: str) -> Model:
    rows = spark.read.text(f"{path}/meta").collect()
    if not rows:
        raise FileNotFoundError(f"no model at {path}; train it first")
    meta = json.loads(rows[0][0])
    meta.pop("trees")
    return Model(stages=PipelineModel.load(f"{path}/stages"), **meta)


def save_run(spark: SparkSession, path: str, eras: scores.Eras, boost: Boost, recipes: dict[str, list[str]]) -> None:
    """Era dates, settings and recipe sizes of a training run."""
    run = {"eras": asdict(eras), "boost": asdict(boost), "recipes": {k: len(v) for k, v in recipes.items()}}
    spark.createDataFrame([(json.dumps(run, default=str),)], "run string").coalesce(1).write.mode("overwrite").text(
        f"{path}/run"
    )
