"""From labelled documents to selected, packed features."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrade.operators import labels as L
from lexigrade.operators import select as S
from lexigrade.operators import vectorize as V
from lexigrade.session import write_stage
from lexigrade.sources.corpus import with_positions

# Fixed value: one selected feature per this many vocabulary terms.
TERMS_PER_FEATURE = 10


@dataclass(frozen=True)
class FeatureParams:
    top_words: int = 10_000
    skip_top_words: int = 20
    skip_least_frequent: int = 0
    representation: str = "bow"

    def __post_init__(self) -> None:
        object.__setattr__(self, "representation", V.check_representation(self.representation))

    @property
    def vocab_size(self) -> int:
        return self.top_words - self.skip_least_frequent

    @property
    def max_terms(self) -> int:
        return self.vocab_size + self.skip_top_words

    @property
    def n_features(self) -> int:
        return int(self.vocab_size / TERMS_PER_FEATURE)


@dataclass(frozen=True)
class FeatureSpace:
    """A vocabulary fitted on the train split: ``(term, term_id, tf, df, idf, weight, rank, kept)``."""

    params: FeatureParams
    terms: DataFrame
    n_terms: int
    n_train: int

    def vocabulary(self) -> DataFrame:
        return self.terms.select("term", "term_id")

    def kept_terms(self) -> DataFrame:
        """The columns of the matrix, heaviest first."""
        return self.terms.where("kept").select("term", "term_id", "weight", "rank").orderBy("rank")

    def vectors(self, docs: DataFrame, keep: tuple[str, ...] = ("split",)) -> DataFrame:
        return V.pack_vectors(docs, self.terms, self.n_terms, self.params.representation, keep)


def fit_vocabulary(docs: DataFrame, params: FeatureParams) -> tuple[DataFrame, int, int]:
    """Stored ``(term, term_id, tf, df, idf)``, its rows and the number of train documents.

    It follows from the texts and ``max_terms``, not from the representation.
    """
    train = docs.where(F.col("split") == "train")
    n_train = train.count()
    vocab = V.fit_vocab(train, params.max_terms)
    stored = write_stage(vocab.withColumn("idf", V.smooth_idf(F.col("df"), n_train)), "vocab")
    return stored, stored.count(), n_train


def _ranked(vocab: DataFrame, weights: DataFrame | None, n_terms: int, params: FeatureParams) -> DataFrame:
    """Weights are term counts, or the given sums of TF-IDF cells."""
    weighted = vocab.withColumn("weight", F.col("tf").cast("double")) if weights is None else vocab.join(weights, "term_id")
    return write_stage(V.rank_terms(weighted, params.skip_top_words, params.vocab_size, n_terms), "terms")


def fit_feature_space(docs: DataFrame, params: FeatureParams, vocabulary: tuple[DataFrame, int, int] | None = None) -> FeatureSpace:
    """Fit on the train rows of ``(doc_id, text, split)``; the fitted table has at most ``max_terms`` rows.

    ``vocabulary`` is what ``fit_vocabulary`` gave for the same documents and ``max_terms``, so that spaces of
    several representations count the texts once.
    """
    vocab, n_terms, n_train = vocabulary or fit_vocabulary(docs, params)
    weights = None
    if params.representation == "tfidf":
        train = docs.where(F.col("split") == "train")
        weights = V.term_weights(V.pack_vectors(train, vocab, n_terms, "tfidf"))
    return FeatureSpace(params, _ranked(vocab, weights, n_terms, params), n_terms, n_train)


def fit_vectors(docs: DataFrame, params: FeatureParams, keep: tuple[str, ...]) -> tuple[FeatureSpace, DataFrame]:
    """The fitted space and the vectors of all documents, with one pass over the texts for each.

    TF-IDF ranks terms by their weights in the vectors: these are stored over the whole vocabulary first and
    dropped terms are cut from the stored rows, so the texts are not shuffled again.
    """
    vocab, n_terms, n_train = fit_vocabulary(docs, params)
    whole = params.representation == "tfidf"
    if not whole:
        space = FeatureSpace(params, _ranked(vocab, None, n_terms, params), n_terms, n_train)
        return space, write_stage(space.vectors(docs, keep), "vectors")
    stored = write_stage(V.pack_vectors(docs, vocab, n_terms, "tfidf", keep), "vectors")
    weights = V.term_weights(stored.where(F.col("split") == "train"))
    space = FeatureSpace(params, _ranked(vocab, weights, n_terms, params), n_terms, n_train)
    kept = space.terms.where("kept").select("term_id", F.col("term_id").alias("feature_id"))
    return space, S.project(stored, kept, n_terms, params.vocab_size, ("doc_id", *keep))


@dataclass(frozen=True)
class LevelData:
    """One label level over the selected features.

    ``rows`` holds ``(doc_id, split, y, ids, vals)`` of all splits, ``train`` the train rows with ``pos``.
    """

    index: DataFrame
    features: DataFrame
    rows: DataFrame
    train: DataFrame
    n_train: int
    classes: tuple[int, ...]
    n_features: int


def encode_level(docs: DataFrame, level: str) -> tuple[DataFrame, DataFrame, int]:
    """Rows of a level with ``y``, its label index and the number of classes; unseen labels are dropped.

    ``docs`` holds the label column, ``split`` and ``doc_id``.
    """
    labelled = docs.where(F.col(level).isNotNull()).withColumn("label", F.col(level))
    index = write_stage(L.label_index(labelled.where(F.col("split") == "train")), "labels")
    n_classes = index.count()
    coded = L.drop_unseen(L.encode_heldout(labelled, index, n_classes))
    return coded, index, n_classes


def preprocess(space: FeatureSpace, vectors: DataFrame, level: str, k: int | None = None) -> LevelData:
    """Select features of a level on train and project all splits.

    ``vectors`` are the packed vectors of the space with the label column of the level.
    """
    coded, index, n_classes = encode_level(vectors, level)
    train = coded.where(F.col("split") == "train")
    n_train = index.agg(F.sum("n_class")).first()[0] or 0
    scores = S.mutual_information(S.contingency(train), index.select("y", "n_class"), n_classes, n_train)
    n_features = k or space.params.n_features
    features = write_stage(S.top_k_features(scores, n_features), "features")
    rows = S.project(coded, features, space.n_terms, n_features, ("doc_id", "split", "y"))
    rows = write_stage(rows, "rows")
    positioned = with_positions(rows.where(F.col("split") == "train").drop("split"), n_train)
    return LevelData(index, features, rows, write_stage(positioned, "train"), n_train, tuple(range(n_classes)), n_features)
