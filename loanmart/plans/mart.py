"""End-to-end pipelines (E8-E9, T6-T7): prepare the mart, split, rebalance,
train, score and evaluate.  Every fitted statistic (correlation filter,
imputation means, dictionaries, scaler, PCA, resampling) is computed on the
training split only and applied to other rows by ``Prepared.transform``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanmart.operators import metrics as M
from loanmart.operators import models as T
from loanmart.operators import network as NN
from loanmart.operators import prep as P
from loanmart.operators import resample as R
from loanmart.operators.boosting import BoostedModel, TreeParams, fit_boosted
from loanmart.operators.sample import hash_split, kfold_assign
from loanmart.operators.target_stats import OrderedTargetEncoder
from loanmart.operators.ward import ward_undersample
from loanmart.operators.windows import padded_sequences
from loanmart.session import cut_lineage, store_rows
from loanmart import constants as C

MODELS = ("gbt", "mlp", "network", "leafwise", "symmetric")
BOOSTED = {"leafwise": "label", "symmetric": "target"}      # boosted trees of this library, and the encoding of their strings
RESAMPLINGS = (None, "cluster", "ward", "cluster_smote", "random_smote")
ENCODINGS = ("onehot", "label", "target")
IMPUTATIONS = ("constant", "mean")


def _choice(name: str, value, allowed) -> None:
    if value not in allowed:
        raise ValueError(f"{name} is {value!r}; one of {allowed}")


@dataclass
class Prepared:
    """Training and hold-out rows ready for a model, and the fitted steps."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    dropped: list[str] = field(default_factory=list)
    id_col: str = ""
    label: str = ""
    string_fill: str = C.STRING_FILL
    imputer: P.MeanImputer | None = None
    encoder: P.SparseOneHot | P.LabelEncoder | OrderedTargetEncoder | None = None

    def transform(self, df: DataFrame) -> DataFrame:
        """The fitted preparation on any rows with the mart's columns; the
        label may be missing.  Values not seen in training become the zero
        vector (one-hot) or -1 (codes)."""
        d = df.drop(*self.dropped)
        d = self.imputer.transform(d) if self.imputer else d
        d = P.impute_constant(d, self.string_fill, 0, exclude=[self.id_col, self.label])
        d = self.encoder.transform(d)
        if isinstance(self.encoder, P.LabelEncoder) and self.encoder.cols:
            d = d.fillna(-1, subset=self.encoder.cols)
        keep = [c for c in (self.id_col, self.label) if c in d.columns]
        return d.select(*keep, *[F.col(f"`{c}`") for c in self.features])

    def save(self, path: str) -> None:
        """The fitted steps below ``path``: settings as text, the encoder's dictionary as Parquet (no rows of data)."""
        e = self.encoder
        kind = {P.SparseOneHot: "onehot", P.LabelEncoder: "label", OrderedTargetEncoder: "target"}[type(e)]
        more = {"onehot": lambda: {"sizes": e.sizes}, "label": lambda: {"missing": e.missing},
                "target": lambda: {"prior": e.prior, "weight": e.weight}}[kind]()
        meta = {"features": self.features, "dropped": self.dropped, "id_col": self.id_col, "label": self.label, "string_fill": self.string_fill,
                "means": self.imputer.means if self.imputer else None, "encoder": kind, "cols": e.cols, **more}
        table = e.stats if kind == "target" else e.codes
        table.write.mode("overwrite").parquet(f"{path}/dictionary")
        spark = table.sparkSession
        spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Prepared":
        """The fitted steps of ``save``, in any session; ``train`` and ``test`` are None."""
        m = json.loads(spark.read.text(f"{path}/meta", wholetext=True).first()[0])
        table = spark.read.parquet(f"{path}/dictionary")
        make = {"onehot": lambda: P.SparseOneHot(m["cols"], table, m["sizes"]), "label": lambda: P.LabelEncoder(m["cols"], table, m["missing"]),
                "target": lambda: OrderedTargetEncoder(m["cols"], m["prior"], m["weight"], table)}
        imputer = P.MeanImputer(m["means"]) if m["means"] is not None else None
        return cls(None, None, m["features"], m["dropped"], m["id_col"], m["label"], m["string_fill"], imputer, make[m["encoder"]]())


def prepare(mart: DataFrame, id_col: str, label: str, test_size: float = C.TEST_SIZE, seed: int = C.SEED,
            exclude: Sequence[str] = (), corr_threshold: float = C.CORR_THRESHOLD, string_fill: str = C.STRING_FILL,
            encoding: str = "onehot", impute: str = "constant") -> Prepared:
    """Split first, then fit the correlation filter, imputation and encoding
    on the training part and apply them to both parts.  Every string column
    is encoded, whatever its number of values: ``onehot`` as one sparse
    vector column, ``label`` as its code, ``target`` as its (for training
    rows ordered) mean label."""
    _choice("encoding", encoding, ENCODINGS)
    _choice("impute", impute, IMPUTATIONS)
    # The mart is a wide plan over every child table; fitting takes many
    # passes, so it is written once to the checkpoint folder, by columns.  Rows for codes and mean
    # labels stay checkpoints, as the bin edges of their learners follow the partitions.
    keep = store_rows if encoding == "onehot" else lambda df, name: cut_lineage(df)
    base = keep(mart.drop(*exclude).withColumn(label, F.col(label).cast("double")), "mart")
    train, test = hash_split(base, id_col, test_size, seed)
    numeric = [c for c in P.columns_of_type(train, strings=False) if c not in (id_col, label)]
    kept, dropped = P.drop_correlated(train, numeric, corr_threshold)
    strings = P.columns_of_type(kept, strings=True)
    strings = [c for c in strings if c != id_col]
    imputer = None
    if impute == "mean":
        imputer = P.MeanImputer.fit(kept, [c for c in P.columns_of_type(kept, strings=False) if c not in (id_col, label)])
        kept = imputer.transform(kept)
    filled = P.impute_constant(kept, string_fill, 0, exclude=[id_col, label])
    if encoding == "target":
        encoder, ordered = OrderedTargetEncoder.fit_transform(filled, id_col, label, strings, seed=seed)
    else:
        encoder = P.SparseOneHot.fit(filled, strings) if encoding == "onehot" else P.LabelEncoder.fit(filled, strings)
    features = [c for c in filled.columns if c not in (id_col, label, *(strings if encoding == "onehot" else ()))]
    if encoding == "onehot":
        features += encoder.outputs
    p = Prepared(train, test, features, dropped, id_col, label, string_fill, imputer, encoder)
    ready = ordered.select(id_col, label, *[F.col(f"`{c}`") for c in features]) if encoding == "target" else p.transform(train)
    p.train, p.test = keep(ready, "train"), keep(p.transform(test), "test")
    return p


@dataclass
class RunConfig:
    id_col: str = "SK_ID_CURR"
    label: str = "TARGET"
    test_size: float = C.TEST_SIZE
    nfolds: int = C.N_FOLDS
    pca_n: int | None = None            # C.PCA_COMPONENTS for the PCA variant
    model: str = "gbt"
    encoding: str = "onehot"
    impute: str = "constant"
    resample: str | None = None
    threshold: float = C.SCORE_THRESHOLD
    seed: int = C.SEED
    max_iter: int = 20
    max_depth: int = 5
    min_gain: float = 0.0
    search_draws: int = 0
    cross_validate: bool = False
    exclude: tuple[str, ...] = ()
    trees: TreeParams | None = None     # of the models leafwise and symmetric
    net: NN.NetParams | None = None     # of the model network


def preset(name: str, **more) -> RunConfig:
    """A run with the source's own choices: ``leafwise`` with the parameters it found, ``symmetric`` with ordered statistics."""
    _choice("preset", name, tuple(BOOSTED))
    trees = TreeParams(n_trees=100, **C.LEAFWISE_PRESET) if name == "leafwise" else TreeParams(grow="symmetric", n_trees=100, max_depth=6, reg_lambda=5.0)
    return RunConfig(model=name, encoding=BOOSTED[name], trees=trees, **more)


def dense_features(df: DataFrame, keep: Sequence[str], cols: Sequence[str], out: str = "x") -> DataFrame:
    """``keep`` and all feature columns (numbers or vectors) as one array."""
    from pyspark.ml.functions import vector_to_array
    packed = T.assembler(cols, "_v").transform(df)
    return packed.select(*keep, vector_to_array("_v").alias(out))


def rebalance(train: DataFrame, cfg: RunConfig, cols: Sequence[str]) -> DataFrame:
    """'cluster': cluster under-sampling to 1:1; 'ward': one row per Ward
    cluster, 1:1; 'cluster_smote' and
    'random_smote': majority to ceil(N/2) and SMOTE up to 1:1.  The result
    has the features in one vector column ``x`` and is written once, so that
    the passes of a fit do not repeat clustering and neighbour search."""
    from pyspark.ml.functions import array_to_vector
    vec = dense_features(train, [cfg.id_col, F.col(cfg.label).cast("int").alias(cfg.label)], cols)
    vec = store_rows(vec, "vectors")
    if cfg.resample == "cluster":
        out = R.cluster_undersample(vec, cfg.id_col, cfg.label, "x", seed=cfg.seed)
    elif cfg.resample == "ward":
        out = ward_undersample(vec, cfg.id_col, cfg.label, "x", seed=cfg.seed)
    else:
        how = R.under_over_sample if cfg.resample == "cluster_smote" else R.random_under_smote
        out = how(vec, cfg.id_col, cfg.label, "x", seed=cfg.seed)
        out = out.select(F.col("row_id").alias(cfg.id_col), F.col("label").alias(cfg.label), F.col("vector").alias("x"))
    return store_rows(out.select(cfg.id_col, F.col(cfg.label).cast("double").alias(cfg.label), array_to_vector("x").alias("x")), "rebalanced")


def feature_width(df: DataFrame, cols: Sequence[str]) -> int:
    """Number of inputs that the feature columns make."""
    row = T.assembler(cols, "_v").transform(df).select("_v").first()
    return len(row["_v"]) if row else len(cols)


def build_pipeline(cfg: RunConfig, cols: Sequence[str], width: int | None = None):
    if cfg.model == "mlp":
        return T.mlp_classifier(cols, cfg.label, max_iter=cfg.max_iter, seed=cfg.seed, width=width)
    pca = min(cfg.pca_n, width or len(cols)) if cfg.pca_n else None
    return T.boosted_trees(cols, cfg.label, pca_n=pca, max_iter=cfg.max_iter, max_depth=cfg.max_depth,
                           seed=cfg.seed, min_gain=cfg.min_gain, width=width)


def evaluate(scored: DataFrame, label: str, threshold: float) -> DataFrame:
    """One row: AUC, confusion counts, precision, recall, F1 and kappa."""
    s = scored.select(F.col(label).cast("int").alias("label"), F.col("score"))
    return M.summary(s, threshold=threshold)


@dataclass
class Ready:
    """Makes prepared rows ready for a model: as they are, or packed into ``x``, one vector (``width``, as rebalanced rows
    are) or one array (``dense``)."""

    keep: list[str]
    features: list[str]
    width: int | None = None
    dense: bool = False

    def sized(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.feature import VectorSizeHint
        return VectorSizeHint(inputCol="x", size=self.width, handleInvalid="optimistic").transform(df)

    def __call__(self, df: DataFrame) -> DataFrame:
        keep = [c for c in self.keep if c in df.columns]
        if self.dense:
            return dense_features(df, keep, self.features)
        if self.width is None:
            return df
        from pyspark.ml.functions import array_to_vector
        return self.sized(dense_features(df, keep, self.features).withColumn("x", array_to_vector("x")))


def save_scorer(path: str, prep: Prepared, model, ready: Ready) -> None:
    """A fitted model with all that scoring raw mart rows needs, below ``path``."""
    spark = prep.train.sparkSession
    prep.save(f"{path}/prepared")
    kind = "trees" if isinstance(model, BoostedModel) else "network" if isinstance(model, NN.NetModel) else "pipeline"
    if kind == "pipeline":
        model.write().overwrite().save(f"{path}/pipeline")
    else:
        model.save(spark, f"{path}/{kind}")
    meta = {"kind": kind, "width": ready.width, "dense": ready.dense}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")


def load_scorer(spark: SparkSession, path: str):
    """(prepared, model, ready) of ``save_scorer`` for ``score_rows``."""
    from pyspark.ml import PipelineModel
    meta = json.loads(spark.read.text(f"{path}/meta", wholetext=True).first()[0])
    prep = Prepared.load(spark, f"{path}/prepared")
    model = {"trees": lambda at: BoostedModel.load(spark, at), "network": lambda at: NN.NetModel.load(spark, at),
             "pipeline": PipelineModel.load}[meta["kind"]](f"{path}/{meta['kind']}")
    return prep, model, Ready([prep.id_col, prep.label], prep.features, meta["width"], meta["dense"])


def fit_model(prep: Prepared, cfg: RunConfig):
    """(fitted model, function that readies prepared rows for it, info)."""
    train, cols, ready = prep.train, prep.features, Ready([cfg.id_col, cfg.label], prep.features)
    if cfg.model in BOOSTED:
        if cfg.resample or cfg.cross_validate or cfg.search_draws:
            raise ValueError(f"model {cfg.model!r} takes no resampling, cross-validation or search")
        trees = cfg.trees or preset(cfg.model).trees
        return fit_boosted(train, cfg.id_col, cfg.label, cols, trees), ready, {"features": len(cols), "dropped_correlated": prep.dropped}
    width = feature_width(train, cols)
    if cfg.model == "network":
        if cfg.resample or cfg.cross_validate or cfg.search_draws:
            raise ValueError("model 'network' takes no resampling, cross-validation or search")
        ready.dense = True
        net = NN.fit_network(ready(train), cfg.id_col, cfg.label, "x", (width,), NN.connected(C.MLP_HIDDEN), cfg.net)
        return net, ready, {"features": width, "dropped_correlated": prep.dropped, "history": net.history}
    if cfg.resample:
        ready.width = width
        train = ready.sized(rebalance(train, cfg, cols))
        cols = ["x"]
    pipe = build_pipeline(cfg, cols, width)
    info: dict = {"features": width, "dropped_correlated": prep.dropped}
    if (cfg.search_draws and cfg.model == "gbt") or cfg.cross_validate:
        folded = store_rows(kfold_assign(train, cfg.id_col, cfg.label, cfg.nfolds, cfg.seed), "folded")
    if cfg.cross_validate:
        info["cv"] = T.cv_auc(pipe, folded, label=cfg.label)
    if cfg.search_draws and cfg.model == "gbt":
        res = T.random_search(pipe, folded, T.GBT_GRID, cfg.search_draws, label=cfg.label, seed=cfg.seed)
        info.update(best_params=res.best_params, search_auc=res.best_auc)
        return res.model, ready, info
    return pipe.fit(train), ready, info


def run(mart: DataFrame, cfg: RunConfig | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """Train and evaluate; returns (metrics row, scored hold-out rows, info).

    ``info`` holds the feature count, dropped columns, the ROC and PR curves
    as frames, and, if asked for, cross-validated AUC and the best draw.
    """
    cfg = cfg or RunConfig()
    _choice("model", cfg.model, MODELS)
    _choice("resample", cfg.resample, RESAMPLINGS)
    fill = C.CLUSTER_STRING_FILL if cfg.resample else C.STRING_FILL
    prep = prepare(mart, cfg.id_col, cfg.label, cfg.test_size, cfg.seed, cfg.exclude, string_fill=fill,
                   encoding=BOOSTED[cfg.model] if cfg.model in BOOSTED and cfg.encoding == "onehot" else cfg.encoding, impute=cfg.impute)
    model, ready, info = fit_model(prep, cfg)
    scored = cut_lineage(T.score(model, ready(prep.test), [cfg.id_col, cfg.label], threshold=cfg.threshold))
    flat = scored.select(F.col(cfg.label).cast("int").alias("label"), "score")
    info.update(roc=M.roc_points(flat), pr=M.pr_points(flat), prepared=prep, model=model)
    return evaluate(scored, cfg.label, cfg.threshold), scored, info


def score_rows(mart: DataFrame, prep: Prepared, model, ready=lambda df: df, threshold: float = C.SCORE_THRESHOLD) -> DataFrame:
    """Scores of rows without labels (S4): same preparation, same model."""
    return T.score(model, ready(prep.transform(mart.drop(prep.label))), [prep.id_col], threshold=threshold)


WIDE = 64                               # values of a string column of a sequence from which on they are hashed


def newest_rows(parent: DataFrame, parent_key: str, child: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
                n: int = C.SEQ_ROWS, test_size: float = 0.0, seed: int = C.SEED, present: bool = False) -> tuple[DataFrame, int]:
    """(one row per parent: its key and ``seq``, the n newest child rows padded and in one array; numbers per child row).

    With ``present`` each row ends in 1, or in 0 after NULLs where there is no child, instead of the padding value.

    String columns among ``cols`` are one-hot encoded by the children of the parents that ``hash_split`` with the
    same seed puts into the training part; columns of more than ``WIDE`` values by that many ranges of their hash.
    """
    from loanmart.functions.scalars import hash_int
    from loanmart.operators.sample import split_flag
    keep = list(dict.fromkeys([key, *order, *cols]))
    child = P.impute_constant(child.select(*keep), exclude=[key, *[c for c in order if c not in cols]])
    strings = [c for c in P.columns_of_type(child, strings=True) if c in cols]
    if strings:
        known = split_flag(child, key, test_size, seed, "_test").filter("_test = 0").drop("_test")
        many = known.agg(*[F.approx_count_distinct(c).alias(c) for c in strings]).first()
        hashed = {c: F.pmod(hash_int(c, seed), F.lit(WIDE)).cast("string") for c in strings if many[c] > WIDE}
        child, known = child.withColumns(hashed), known.withColumns(hashed)
        encoder = P.OneHot.fit(known, strings, drop_first=False)
        child = encoder.transform(child)
        cols = [c for c in child.columns if c in cols or any(c.startswith(f"{x}_") for x in strings)]
        child = child.withColumnsRenamed({c: f"_f{i}" for i, c in enumerate(cols) if c not in order})
        cols = [c if c in order else f"_f{i}" for i, c in enumerate(cols)]
    if not present:
        return cut_lineage(padded_sequences(parent, parent_key, child, key, order, cols, n=n, pad=C.SEQ_PAD)), len(cols)
    child, cols, w = child.withColumn("_here", F.lit(1.0)), [*cols, "_here"], len(cols) + 1
    seq = padded_sequences(parent, parent_key, child, key, order, cols, n=n, pad=C.SEQ_PAD)
    here = lambda i: F.get("seq", (F.floor(i / w) * w + w - 1).cast("int")) == 1.0
    shown = F.transform("seq", lambda v, i: F.when(here(i), v).when(i % w == w - 1, 0.0))
    return cut_lineage(seq.select(parent_key, shown.alias("seq"))), w


def sequence_embedding(parent: DataFrame, parent_key: str, child: DataFrame, key: str, order: Sequence[str],
                       cols: Sequence[str], n: int = C.SEQ_ROWS, k: int = C.SEQ_FEATURES,
                       prefix: str = C.SEQ_PREFIX, test_size: float = 0.0, seed: int = C.SEED) -> DataFrame:
    """T6 without labels: ``newest_rows`` -> standardise -> PCA(k) -> ``bfeat_1..k`` per parent, fitted on the training part."""
    from pyspark.ml.functions import vector_to_array
    from loanmart.operators.sample import split_flag
    seq, width = newest_rows(parent, parent_key, child, key, order, cols, n, test_size, seed)
    k = min(k, n * width)
    flat = seq.select(parent_key, *[F.col("seq")[i].alias(f"_s{i}") for i in range(n * width)])
    train = split_flag(flat, parent_key, test_size, seed, "_test").filter("_test = 0").drop("_test")
    out, _model, _ev = P.pca_features(flat, [f"_s{i}" for i in range(n * width)], k, out="_pc", fit_on=train)
    arr = vector_to_array("_pc")
    return out.select(parent_key, *[arr[i].alias(f"{prefix}{i + 1}") for i in range(k)])


SEQUENCE_NETS = ("conv", "lstm")


def learned_sequence_features(parent: DataFrame, parent_key: str, label: str, child: DataFrame, key: str, order: Sequence[str],
                              cols: Sequence[str], how: str = "conv", n: int = C.SEQ_ROWS, k: int = C.SEQ_FEATURES, prefix: str = C.SEQ_PREFIX,
                              test_size: float = 0.0, seed: int = C.SEED, params: NN.NetParams | None = None) -> tuple[DataFrame, NN.NetModel]:
    """(``bfeat_1..k`` per parent, the network): the hidden layer of a convolutional or recurrent network over ``newest_rows``,
    trained on the labels of the training part.  Parents without children have empty sequences, and features too."""
    from loanmart.operators.sample import split_flag
    _choice("how", how, SEQUENCE_NETS)
    seq, width = newest_rows(parent, parent_key, child, key, order, cols, n, test_size, seed, present=True)
    if how == "conv" and (n < 4 or width < 4):
        raise ValueError("two poolings need four rows and four columns at least")
    layers, at = NN.convolutional(k) if how == "conv" else NN.recurrent(k)
    shape = (n, width, 1) if how == "conv" else (n, width)
    labels = parent.select(parent_key, F.col(label).cast("double").alias("_y"))
    train = split_flag(seq.join(labels, parent_key), parent_key, test_size, seed, "_test").filter("_test = 0")
    model = NN.fit_network(train, parent_key, "_y", "seq", shape, layers, params)
    out = model.hidden(seq, [parent_key], "seq", at)
    return out.select(parent_key, *[F.col("hidden")[i].alias(f"{prefix}{i + 1}") for i in range(k)]), model


# File names of the credit tables in a data folder.
CREDIT_FILES = {
    "application": "application_train.csv",
    "previous_application": "previous_application.csv",
    "credit_card_balance": "credit_card_balance.csv",
    "installments_payments": "installments_payments.csv",
    "POS_CASH_balance": "POS_CASH_balance.csv",
    "bureau": "bureau.csv",
    "bureau_balance": "bureau_balance.csv",
}


def build_credit_mart(spark, data_dir: str, application_file: str | None = None,
                      include_credit_types: bool = True) -> DataFrame:
    """E7 on the credit CSV files of ``data_dir``: one row per application
    with every block attached (prefixes ``bur_ prev_ cc_ ins_ pos_``).
    ``application_file`` selects e.g. the unlabelled scoring table."""
    from loanmart.plans import blocks as B
    from loanmart.sources.credit import read_credit_table

    def read(name: str, file: str | None = None) -> DataFrame:
        return read_credit_table(spark, f"{data_dir.rstrip('/')}/{file or CREDIT_FILES[name]}", name)

    app = read("application", application_file)
    return B.feature_mart(
        B.application_features(app, clean=application_file is None),
        B.bureau_parts(read("bureau"), read("bureau_balance"), B.BureauSpec(include_credit_types=include_credit_types)),
        B.previous_block(read("previous_application")),
        B.card_parts(read("credit_card_balance")),
        B.installment_block(read("installments_payments")),
        B.pos_parts(read("POS_CASH_balance")))


def credit_entityset(spark, data_dir: str):
    """D1 on the credit CSV files: 7 tables, 6 parent -> child edges.  Month
    tables have no key of their own; the applicant id they also carry is
    ignored so it is not aggregated as a number."""
    from loanmart.operators.synth import EntitySet
    from loanmart.sources.credit import read_credit_table

    def read(name: str) -> DataFrame:
        return read_credit_table(spark, f"{data_dir.rstrip('/')}/{CREDIT_FILES[name]}", name)

    es = EntitySet()
    es.add("train", read("application"), "SK_ID_CURR")
    es.add("bureau", read("bureau"), "SK_ID_BUREAU")
    es.add("bureaubal", read("bureau_balance"), "_none")
    es.add("prev", read("previous_application"), "SK_ID_PREV")
    for name, table in (("ccb", "credit_card_balance"), ("insta", "installments_payments"), ("pc", "POS_CASH_balance")):
        es.add(name, read(table), "_none", ignore=("SK_ID_CURR",))
    es.relate("train", "SK_ID_CURR", "bureau", "SK_ID_CURR")
    es.relate("bureau", "SK_ID_BUREAU", "bureaubal", "SK_ID_BUREAU")
    es.relate("train", "SK_ID_CURR", "prev", "SK_ID_CURR")
    for child in ("ccb", "insta", "pc"):
        es.relate("prev", "SK_ID_PREV", child, "SK_ID_PREV")
    return es


def credit_training_table(spark, data_dir: str, features: str = "manual", depth: int = 2,
                          seq_features: int = C.SEQ_FEATURES) -> DataFrame:
    """The training table of one feature strategy, from the credit CSV files:

    * ``manual``: the hand-built feature mart (E7);
    * ``automated``: relational synthesis over the seven tables (E8);
    * ``sequence``: the application table with the newest-5 bureau
      sequence features ``bfeat_*`` (T6) joined by key; ``conv`` and ``lstm``: with
      those a network learns.
    The result goes to ``run(table, RunConfig(...))``.
    """
    from loanmart.sources.credit import read_credit_table
    if features == "manual":
        return build_credit_mart(spark, data_dir)
    if features == "automated":
        from loanmart.operators.synth import synthesize
        return synthesize(credit_entityset(spark, data_dir), "train", depth=depth)
    if features in ("sequence", *SEQUENCE_NETS):
        app = read_credit_table(spark, f"{data_dir.rstrip('/')}/{CREDIT_FILES['application']}", "application")
        bureau = read_credit_table(spark, f"{data_dir.rstrip('/')}/{CREDIT_FILES['bureau']}", "bureau")
        cols = [f.name for f in bureau.schema.fields if f.name not in ("SK_ID_CURR", "SK_ID_BUREAU")
                and f.dataType.typeName() in ("double", "integer", "long", "string")]
        order = ["DAYS_CREDIT", "SK_ID_BUREAU"]
        if features == "sequence":
            seq = sequence_embedding(app, "SK_ID_CURR", bureau, "SK_ID_CURR", order, cols, k=seq_features, test_size=C.TEST_SIZE)
        else:
            seq, _net = learned_sequence_features(app, "SK_ID_CURR", "TARGET", bureau, "SK_ID_CURR", order, cols, features, k=seq_features,
                                                  test_size=C.TEST_SIZE)
        return app.join(seq, on="SK_ID_CURR", how="left")
    raise ValueError(f"unknown feature strategy {features!r}")
