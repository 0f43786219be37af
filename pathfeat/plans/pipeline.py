"""The whole pipeline: arcs and labels to vectors, files and evaluation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as feat
from ..operators import sketch
from ..operators import vocabulary as voc
from ..operators.classify import ModelOptions, cross_validate, decision_trees, linear_models
from ..operators.evaluate import class_details, confusion_samples, summary, weighted_average
from ..operators.linear import LinearModels
from ..operators.parse import parse_arcs, parse_labels, reject_labels
from ..operators.paths import path_records
from ..operators.stemming import stem_labels
from ..options import Options
from ..sources.arff import arff_lines, write_arff
from ..sources.legacy import SIZE_KEY
from ..sources.routed import RoutedLines, stage_routed
from ..sources.text import read_lines, write_tsv
from .outputs import Outputs, files_fingerprint, fingerprint
from .staging import Staging, stage, stage_by


class FeaturePlan:
    """The steps over one corpus and one label list, each computed when asked for.

    Tables that several steps read (``cells``, ``vocabulary``, ``pairs``, ``found``, and
    ``records`` if they are kept) are staged once, so asking for a step whose plan
    reads them runs the jobs that write them; everything else is a lazy plan.

    ``keep_records`` stages the path records, for plans that put them out: the corpus is
    then walked once, and the cells are counted from the staged table. ``prune`` keeps the
    records of paths that can't reach ``dpmin`` out of the count: the corpus is walked
    twice unless records are kept, and ``cells`` and ``support`` lack such paths; all
    that is derived from frequent paths is the same. ``pairs`` and ``found`` are dealt into
    ``buckets`` by pair, so the steps that join them or group by pair shuffle neither again;
    without a number, the session's number of shuffle partitions. ``staging`` names the folder for
    staged tables. ``close``, or leaving a ``with`` block, deletes them.
    """

    def __init__(
        self,
        arcs: DataFrame | None,
        labels: DataFrame | None = None,
        options: Options = Options(),
        *,
        keep_records: bool = False,
        prune: bool = False,
        buckets: int | None = None,
        staging: str | None = None,
    ) -> None:
        self.arcs = arcs
        self.labels = labels
        self.options = options
        self.keep_records = keep_records
        self.prune = prune
        self.buckets = buckets
        self.routed: RoutedLines | None = None
        self.staging = Staging(staging)

    @classmethod
    def from_lines(
        cls,
        lines: DataFrame,
        labels: DataFrame | None = None,
        options: Options = Options(),
        *,
        keep_records: bool = False,
        prune: bool = False,
        buckets: int | None = None,
        staging: str | None = None,
    ) -> FeaturePlan:
        """A plan over corpus lines that also gives ``routed``, its rejects and the number
        of either kind: the lines are read once, now."""
        settings = {"keep_records": keep_records, "prune": prune, "buckets": buckets, "staging": staging}
        plan = cls(None, labels, options, **settings)
        plan.routed = stage_routed(lines, plan.staging)
        plan.arcs = plan.routed.arcs
        return plan

    @classmethod
    def from_tables(
        cls,
        cells: DataFrame,
        vocabulary: DataFrame | None = None,
        labels: DataFrame | None = None,
        options: Options = Options(),
        *,
        buckets: int | None = None,
        staging: str | None = None,
    ) -> FeaturePlan:
        """Go on from written tables: ``cells`` as ``dp, a, b, n`` and, unless it is to be
        made anew, ``vocabulary`` as ``dp, id``. Steps that need the corpus fail."""
        plan = cls(None, labels, options, buckets=buckets, staging=staging)
        plan.adopt("cells", cells)
        if vocabulary is not None:
            plan.adopt("vocabulary", vocabulary)
        return plan

    def __enter__(self) -> FeaturePlan:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Delete the staged tables; what was asked for before can't be read any more."""
        self.staging.close()

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        with self.staging:
            return stage(df, name)

    @cached_property
    def records(self) -> DataFrame:
        if self.arcs is None:
            raise ValueError("this step needs the corpus")
        records = path_records(self.arcs, self.options)
        return self._stage(records, "records") if self.keep_records else records

    def adopt(self, step: str, rows: DataFrame) -> None:
        """Take ``rows`` for a step, as a table that was written from it."""
        if not isinstance(getattr(type(self), step, None), cached_property):
            raise ValueError(f"there is no step {step}")
        self.__dict__[step] = rows

    def count_cells(self) -> DataFrame:
        """``cells``, not staged."""
        records = self.records.select("dp", "a", "b")
        if self.prune:
            counters = self._stage(sketch.support_sketch(records), "sketch")
            bits = self._stage(sketch.heavy_bits(counters, self.options.dpmin), "bits")
            records = sketch.possibly_frequent(records, bits)
        return voc.path_cells(records)

    @cached_property
    def cells(self) -> DataFrame:
        return self._stage(self.count_cells(), "cells")

    @cached_property
    def support(self) -> DataFrame:
        return voc.path_support(self.cells)

    @cached_property
    def frequent(self) -> DataFrame:
        return voc.frequent_paths(self.support, self.options.dpmin)

    def number_paths(self) -> DataFrame:
        """``vocabulary``, not staged."""
        with self.staging:
            return voc.number_paths(self.frequent)

    @cached_property
    def vocabulary(self) -> DataFrame:
        return self._stage(self.number_paths(), "vocabulary")

    @cached_property
    def size(self) -> DataFrame:
        return voc.vector_size(self.vocabulary)

    @cached_property
    def kept_records(self) -> DataFrame:
        return voc.kept_records(self.records, self.vocabulary)

    @cached_property
    def numbered_pairs(self) -> DataFrame:
        return feat.numbered_pairs(self.records, self.vocabulary, self.options)

    @cached_property
    def pairs(self) -> DataFrame:
        """Labelled pairs, stemmed, one label each."""
        if self.labels is None:
            raise ValueError("this step needs a label list")
        stemmed = stem_labels(self.labels.select("w1", "w2", "label"), self.options)
        with self.staging:
            return stage_by(feat.pair_labels(stemmed, self.options), "pairs", ["a", "b"], self.buckets)

    @cached_property
    def found(self) -> DataFrame:
        """Cells of labelled pairs: ``a, b, label, id, n``."""
        cells = feat.labelled_cells(self.cells, self.vocabulary, self.pairs, self.options)
        with self.staging:
            return stage_by(cells, "found", ["a", "b"], self.buckets)

    @cached_property
    def label_join(self) -> DataFrame:
        return feat.label_join(self.found, self.pairs)

    @cached_property
    def without_evidence(self) -> DataFrame:
        return feat.labels_without_evidence(self.found, self.pairs)

    @cached_property
    def sparse(self) -> DataFrame:
        return feat.sparse_vectors(self.found)

    @cached_property
    def vectors(self) -> DataFrame:
        return feat.dense_vectors(self.sparse, self.size)

    @cached_property
    def dense_cells(self) -> DataFrame:
        return feat.dense_cells(self.found, self.pairs, self.size)

    def arff_lines(self, form: str = "dense") -> DataFrame:
        with self.staging:
            return arff_lines(self.sparse, self.vocabulary, self.size, form)

    def write_arff(self, path: str, form: str = "dense") -> None:
        with self.staging:
            write_arff(self.sparse, self.vocabulary, self.size, path, form=form)

    def predictions(
        self,
        classifier: str = "decision_tree",
        folds: int = 10,
        models: ModelOptions = ModelOptions(),
    ) -> DataFrame:
        size = self.size.first()["vec_size"]
        with self.staging:
            return cross_validate(self.sparse, size, classifier, folds, models)

    def linear_models(
        self, classifier: str = "logistic", folds: int = 10, models: ModelOptions = ModelOptions()
    ) -> LinearModels:
        """Every fold's linear model as a table, see ``operators.linear``."""
        size = self.size.first()["vec_size"]
        with self.staging:
            return linear_models(self.sparse, size, classifier, folds, models)

    def trees(self, folds: int = 10, models: ModelOptions = ModelOptions()) -> DataFrame:
        """The nodes of every fold's decision tree, see ``operators.tree``."""
        with self.staging:
            return decision_trees(self.sparse, folds, models).table()


def run(
    spark: SparkSession,
    corpus: str | list[str],
    label_list: str | list[str],
    output: str,
    options: Options = Options(),
    *,
    classifier: str | None = "decision_tree",
    folds: int = 10,
    models: ModelOptions = ModelOptions(),
    write_records: bool = False,
    write_rejects: bool = True,
    text_copies: bool = False,
    arff_form: str = "dense",
    kept_paths_only: bool = False,
    resume: bool = False,
    partitions: int | None = None,
    buckets: int | None = None,
    staging: str | None = None,
) -> FeaturePlan:
    """Read a corpus and a label list, write every result below ``output``.

    Parquet: ``cells``, ``frequent_paths``, ``vocabulary``, ``vector_size``, ``label_join``,
    ``without_evidence``, ``vectors`` (sparse) and, on request, ``kept_records`` and
    ``numbered_pairs``; ``arff`` as text, with ``dense`` or ``sparse`` lines. With a classifier also ``predictions``,
    ``summary``, ``class_details`` and ``samples``. ``text_copies`` adds the
    tab-separated form of the vocabulary and its size. With rejects, lines are read and
    parsed once into a staged table of arcs and one of rejects, and ``line_counts`` has
    their numbers. ``kept_paths_only`` leaves cells of paths that can't reach ``dpmin`` out
    of ``cells`` and out of the shuffle. ``partitions`` spreads a corpus of files that
    can't be split.

    ``resume`` goes on after a run into the same folder that was broken off: tables that
    are finished and were made from the same files and options are read, all others
    are made, in place of what is there. The corpus is read only if a table that comes
    from it is missing, so another ``dpmin`` or label list starts from the cells.

    The plan that is returned reads ``cells``, ``vocabulary`` and ``vectors`` from
    ``output``. Close it to delete staged tables; ``FeaturePlan.from_tables`` goes on from
    the written ones.
    """
    out = Outputs(spark, output, resume)
    label_lines = spark.read.text(label_list)
    labels = parse_labels(label_lines)
    settings = {"keep_records": write_records, "prune": kept_paths_only, "buckets": buckets, "staging": staging}
    marks = _marks(spark, corpus, label_list, options, kept_paths_only, (classifier, folds, asdict(models)))

    of_corpus = ["cells"]
    of_corpus += ["kept_records", "numbered_pairs"] if write_records else []
    of_corpus += ["rejected_lines", "line_counts"] if write_rejects else []
    missing = [name for name in of_corpus if not out.finished(name, marks[name])]
    if not missing:
        plan = FeaturePlan(None, labels, options, **settings)
    else:
        lines = read_lines(spark, corpus, partitions)
        if write_rejects:
            plan = FeaturePlan.from_lines(lines, labels, options, **settings)
        else:
            plan = FeaturePlan(parse_arcs(lines), labels, options, **settings)

    def write(name: str, rows: Callable[[], DataFrame]) -> DataFrame:
        return out.table(name, marks[name], rows)

    plan.adopt("cells", write("cells", plan.count_cells))
    plan.adopt("frequent", write("frequent_paths", lambda: plan.frequent))
    plan.adopt("vocabulary", write("vocabulary", plan.number_paths))
    write("vector_size", lambda: plan.size)
    if text_copies:
        size = plan.size.select(F.lit(SIZE_KEY).alias("key"), "vec_size")
        for name, df in (("vocabulary_tsv", plan.vocabulary.select("dp", "id")), ("vector_size_tsv", size)):
            out.make(name, marks["vocabulary"], partial(write_tsv, df))
    if write_records:
        write("kept_records", lambda: plan.kept_records)
        write("numbered_pairs", lambda: plan.numbered_pairs)
    if write_rejects:
        write("rejected_lines", lambda: plan.routed.rejects)
        write("rejected_labels", lambda: reject_labels(label_lines))
        write("line_counts", lambda: plan.routed.counts)
    write("label_join", lambda: plan.label_join)
    write("without_evidence", lambda: plan.without_evidence)
    plan.adopt("sparse", write("vectors", lambda: plan.sparse))
    out.make("arff", fingerprint(marks["vectors"], arff_form), partial(plan.write_arff, form=arff_form))
    if classifier is not None:
        predictions = write("predictions", lambda: plan.predictions(classifier, folds, models))
        with plan.staging:
            write("summary", lambda: summary(predictions))
            write("class_details", lambda: class_details(predictions))
            write("weighted_average", lambda: weighted_average(predictions))
            write("samples", lambda: confusion_samples(predictions))
    return plan


def _marks(
    spark: SparkSession,
    corpus: str | list[str],
    label_list: str | list[str],
    options: Options,
    pruned: bool,
    training: tuple,
) -> dict[str, str]:
    """What every table of a run is made from: the files, options and tables that bear on
    it. How walks are unrolled, where tables are staged and how many tasks there are
    changes no result."""
    o = asdict(options)
    words = [o["stem_scope"], o["lower"]]
    lines, pairs = files_fingerprint(spark, corpus), files_fingerprint(spark, label_list)
    walked = [lines, *words, o["path_format"], o["noun_on"], o["pair_scope"]]
    cells = fingerprint("cells", walked, o["dpmin"] if pruned else None)
    vocabulary = fingerprint("vocabulary", fingerprint("cells", walked, None), o["dpmin"])
    found = fingerprint("found", vocabulary, pairs, *words, o["symmetric"], o["label_rule"])
    trained = fingerprint("trained", found, training)
    groups = {
        fingerprint("lines", lines): ["rejected_lines", "line_counts"],
        fingerprint("pairs", pairs): ["rejected_labels"],
        cells: ["cells"],
        vocabulary: ["frequent_paths", "vocabulary", "vector_size"],
        fingerprint("kept", vocabulary): ["kept_records"],
        fingerprint("numbered", vocabulary, o["symmetric"]): ["numbered_pairs"],
        found: ["label_join", "without_evidence", "vectors"],
        trained: ["predictions", "summary", "class_details", "weighted_average", "samples"],
    }
    return {name: mark for mark, names in groups.items() for name in names}
