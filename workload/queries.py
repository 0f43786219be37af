"""One query per operator, each over the whole of the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathfeat import FeaturePlan, Options
from pathfeat.functions.stemmer import stem
from pathfeat.operators import evaluate, features, graph, vocabulary
from pathfeat.operators.classify import ModelOptions, assign_folds, with_prior
from pathfeat.operators.parse import parse_arcs, parse_labels, reject_arcs, reject_labels
from pathfeat.operators.paths import line_text, path_records
from pathfeat.operators.stemming import stem_arcs
from pathfeat.plans.staging import CHECKPOINT_DIR, Staging, stage, staging_root
from pathfeat.plans.store import CellStore
from pathfeat.sources import arff, legacy
from pathfeat.sources.parts import part_list
from pathfeat.sources.routed import stage_routed
from pathfeat.sources.text import read_arcs, read_tsv, write_tsv

from . import corpus

OPTIONS = Options(dpmin=100)


def plan(
    spark: SparkSession, sf_dir: str, options: Options = OPTIONS, keep_records: bool = False
) -> FeaturePlan:
    arcs, labels = corpus.arcs(spark, sf_dir), corpus.labels(spark, sf_dir)
    return FeaturePlan(arcs, labels, options, keep_records=keep_records)


def _folder(spark: SparkSession, name: str) -> str:
    root = staging_root(spark)
    if root is None:
        raise ValueError(f"writing text needs {CHECKPOINT_DIR}")
    return f"{root}/pathfeat/{name}-{uuid.uuid4().hex}"


def _tokens(arcs: DataFrame) -> DataFrame:
    token = F.posexplode("toks").alias("at", "tok")
    return arcs.select("doc_id", "line_no", "head", token).select(
        "doc_id", "line_no", "head", (F.col("at") + 1).alias("k"), "tok.*"
    )


def parsed(spark, sf_dir):
    return _tokens(parse_arcs(corpus.arc_lines(spark, sf_dir)))


def rejected(spark, sf_dir):
    return reject_arcs(corpus.arc_lines(spark, sf_dir)).select("doc_id", "line_no", "reason")


def stem_vocabulary(spark, sf_dir):
    words = F.regexp_extract_all("text", F.lit(r"(\p{L}+)"), F.lit(1))
    docs = corpus.spread(corpus.table(spark, sf_dir, "documents").select("text"))
    distinct = docs.select(F.explode(words).alias("word")).distinct()
    return distinct.select("word", stem("word").alias("stem"))


def stemmed(spark, sf_dir):
    return _tokens(stem_arcs(corpus.arcs(spark, sf_dir))).select(
        "doc_id", "line_no", "head", "k", "word"
    )


def head_graph(spark, sf_dir):
    return graph.head_graph(stem_arcs(corpus.arcs(spark, sf_dir)))


def noun_pairs(spark, sf_dir):
    return graph.noun_pairs(stem_arcs(corpus.arcs(spark, sf_dir)))


def noun_pairs_first_half(spark, sf_dir):
    options = OPTIONS.but(pair_scope="first_half")
    return graph.noun_pairs(stem_arcs(corpus.arcs(spark, sf_dir)), options)


def records(spark, sf_dir):
    return path_records(corpus.arcs(spark, sf_dir)).select("doc_id", "line_no", "dp", "a", "b")


def records_first_half(spark, sf_dir):
    options = OPTIONS.but(pair_scope="first_half")
    return path_records(corpus.arcs(spark, sf_dir), options).select(
        "doc_id", "line_no", "dp", "a", "b"
    )


def reject_arcs_long(spark, sf_dir):
    return reject_arcs(corpus.long_arc_lines(spark, sf_dir)).select("doc_id", "line_no", "reason")


def head_graph_long(spark, sf_dir):
    return graph.head_graph(stem_arcs(corpus.long_arcs(spark, sf_dir)))


def path_records_long(spark, sf_dir):
    """Walks of any length, with cycles, missing roots and lines of any length."""
    return path_records(corpus.long_arcs(spark, sf_dir)).select("doc_id", "line_no", "dp", "a", "b")


def path_formats(spark, sf_dir):
    formats = ["word_pos_label", "word_label"]
    records = path_records(corpus.arcs(spark, sf_dir), OPTIONS, formats=formats)
    return records.select(F.col("_format").alias("format"), "doc_id", "line_no", "dp", "a", "b")


def path_cells(spark, sf_dir):
    return vocabulary.path_cells(path_records(corpus.arcs(spark, sf_dir)))


def path_support(spark, sf_dir):
    return vocabulary.path_support(path_cells(spark, sf_dir))


def frequent_paths(spark, sf_dir):
    return vocabulary.frequent_paths(path_support(spark, sf_dir), OPTIONS.dpmin)


def frequent_word_paths(spark, sf_dir):
    """Frequent paths of a word format, counted without the paths that can't be frequent."""
    options = OPTIONS.but(path_format="word_label", dpmin=5)
    arcs = corpus.arcs(spark, sf_dir).select("head", "toks")
    return FeaturePlan(arcs, options=options, prune=True, keep_records=True).frequent


def routed_lines(spark, sf_dir):
    """Lines of the corpus of longer lines by what they are, from one read of them."""
    routed = stage_routed(corpus.long_arc_lines(spark, sf_dir), Staging())
    arcs = routed.arcs.select("doc_id", "line_no", F.size("toks").alias("n_tokens"), F.lit(None).cast("string").alias("reason"))
    rejects = routed.rejects.select("doc_id", "line_no", F.lit(None).cast("int").alias("n_tokens"), "reason")
    return arcs.unionByName(rejects)


def merged_corpora(spark, sf_dir):
    """Support over a corpus that came in two additions of files, the second one listing
    the first one's files again."""
    path, arcs = _folder(spark, "halves"), corpus.arcs(spark, sf_dir)
    lines = arcs.select("doc_id", "line_no", line_text(F.col("head"), F.col("toks")).alias("value"))
    store = CellStore(spark, f"{path}/store", OPTIONS)
    half = F.pmod(F.xxhash64("doc_id", "line_no"), F.lit(2)).alias("half")
    lines.select("value", half).write.partitionBy("half").text(f"{path}/corpus")
    for files in ("half=0", "*"):
        store.add(f"{path}/corpus/{files}")
    return vocabulary.path_support(store.cells)


def path_ids(spark, sf_dir):
    return plan(spark, sf_dir).vocabulary


def vector_size(spark, sf_dir):
    return plan(spark, sf_dir).size


def max_by_key(spark, sf_dir):
    return vocabulary.max_by_key(path_cells(spark, sf_dir), "dp", "n")


def kept_records(spark, sf_dir):
    return plan(spark, sf_dir, keep_records=True).kept_records.select("doc_id", "line_no", "dp", "a", "b")


def numbered_pairs(spark, sf_dir):
    return plan(spark, sf_dir, keep_records=True).numbered_pairs.select("doc_id", "line_no", "id", "dp", "a", "b")


def label_rows(spark, sf_dir):
    lines = corpus.label_lines(spark, sf_dir)
    kept = parse_labels(lines).select(
        F.concat_ws(" ", "w1", "w2", F.col("label").cast("string")).alias("line"),
        F.lit("kept").alias("outcome"),
    )
    lost = reject_labels(lines).select(
        F.concat_ws(" ", F.filter(F.split("value", " +"), lambda w: w != "")).alias("line"),
        F.col("reason").alias("outcome"),
    )
    return kept.unionByName(lost).groupBy("line", "outcome").agg(F.count("*").alias("n"))


def labelled_pairs(spark, sf_dir):
    return plan(spark, sf_dir).pairs


def labelled_pairs_without_conflicts(spark, sf_dir):
    return plan(spark, sf_dir, OPTIONS.but(label_rule="drop_conflicts")).pairs


def label_join(spark, sf_dir):
    return plan(spark, sf_dir).label_join


def labels_without_evidence(spark, sf_dir):
    return plan(spark, sf_dir).without_evidence


def pair_path_counts(spark, sf_dir):
    return plan(spark, sf_dir).found


def pair_path_counts_directed(spark, sf_dir):
    return plan(spark, sf_dir, OPTIONS.but(symmetric=False)).found


def dense_cells(spark, sf_dir):
    return plan(spark, sf_dir).dense_cells


def _vector_rows(vectors: DataFrame) -> DataFrame:
    text = F.concat_ws(",", F.transform("features", lambda n: n.cast("string")))
    return vectors.select("a", "b", "label", text.alias("vector"))


def labeled_vectors(spark, sf_dir):
    return _vector_rows(plan(spark, sf_dir).vectors)


def labeled_vectors_compatible(spark, sf_dir):
    """Under the line semantics of the original jobs."""
    options = OPTIONS.but(stem_scope="descriptor", pair_scope="first_half")
    return _vector_rows(plan(spark, sf_dir, options).vectors)


def arff_lines(spark, sf_dir):
    return plan(spark, sf_dir).arff_lines()


def arff_roundtrip(spark, sf_dir):
    p = plan(spark, sf_dir)
    path = _folder(spark, "arff")
    p.write_arff(path)
    return _vector_rows(arff.read_arff_pairs(spark, path))


def sparse_arff_lines(spark, sf_dir):
    """The document with sparse data lines."""
    return plan(spark, sf_dir).arff_lines("sparse")


def sparse_arff_roundtrip(spark, sf_dir):
    """Vectors that were written as sparse lines and read again, made dense."""
    p = plan(spark, sf_dir)
    path = _folder(spark, "sparse-arff")
    p.write_arff(path, "sparse")
    return _vector_rows(features.dense_vectors(arff.read_sparse_arff_pairs(spark, path), p.size))


def arff_bytes(spark, sf_dir):
    """Bytes of the document, from the list of its parts."""
    path = _folder(spark, "parts")
    plan(spark, sf_dir).write_arff(path)
    listed = part_list(spark, path)
    return listed.agg(F.max(F.col("first") + F.col("length")).alias("n_bytes"))


def resumed_vectors(spark, sf_dir):
    """Vectors from cells and a vocabulary that were written and read again."""
    first = plan(spark, sf_dir)
    path = _folder(spark, "resumed")
    first.cells.write.parquet(f"{path}/cells")
    first.vocabulary.write.parquet(f"{path}/vocabulary")
    second = FeaturePlan.from_tables(
        spark.read.parquet(f"{path}/cells"),
        spark.read.parquet(f"{path}/vocabulary"),
        corpus.labels(spark, sf_dir),
        OPTIONS,
    )
    return _vector_rows(second.vectors)


def tsv_roundtrip(spark, sf_dir):
    """All labelled pairs with their cells, written as text and read again; pairs without
    evidence have nulls."""
    path = _folder(spark, "tsv")
    found = plan(spark, sf_dir).label_join.select("a", "id", "b", "n", "label")
    write_tsv(found, path)
    return read_tsv(spark, path, "a string, id bigint, b string, n bigint, label boolean")


def text_corpus(spark, sf_dir):
    """Arcs of a corpus that was written as text and read as files."""
    path = _folder(spark, "corpus")
    corpus.arc_lines(spark, sf_dir).select("value").write.text(path)
    arcs = read_arcs(spark, path)
    return arcs.groupBy("head", F.size("toks").alias("n_tokens")).agg(F.count("*").alias("n_lines"))


def legacy_text_records(spark, sf_dir):
    """Every record type as one mix of text lines, routed and parsed back."""
    p = plan(spark, sf_dir)
    c = F.col
    # One walk over the corpus for the cells and both kinds of records with their line.
    with p.staging:
        records = stage(path_records(p.arcs.select("head", "toks"), p.options, with_line=True), "records")
    p.adopt("records", records)
    numbered = features.numbered_pairs(records, p.vocabulary, p.options)
    vectors = _vector_rows(p.vectors)
    lines = (
        p.pairs.select(legacy.label_record(c("a"), c("b"), c("label")).alias("value"))
        .unionByName(
            numbered.select(
                legacy.numbered_record(c("a"), c("b"), c("id"), c("dp"), c("line")).alias("value")
            )
        )
        .unionByName(
            records.select(legacy.path_record(c("dp"), c("a"), c("b"), c("line")).alias("value"))
        )
        .unionByName(
            vectors.select(
                legacy.vector_record(c("a"), c("b"), c("vector"), c("label")).alias("value")
            )
        )
        .unionByName(
            p.found.withColumn("size", p.size.scalar()).select(
                legacy.cell_record(c("a"), c("b"), c("id"), c("n"), c("size")).alias("value")
            )
        )
        .unionByName(
            p.vocabulary.select(legacy.vocabulary_record(c("dp"), c("id")).alias("value"))
        )
        .unionByName(p.size.select(legacy.size_record(c("vec_size")).alias("value")))
        .unionByName(p.pairs.select(F.concat_ws(" ", "a", "b", "a").alias("value")))
    )
    routed = legacy.route_records(lines)
    # The text of a line is long; its length tells as much.
    length = F.when(c("kind") != "reject", F.length("line")).alias("line_length")
    kept = F.when(c("kind") == "reject", c("line")).alias("rejected")
    return routed.select(
        "kind", "a", "b", "label", "id", "dp", "n", "vector", length, kept, "reason"
    )


def rule_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a fixed rule: the share of a pair's evidence on paths that end
    in the tag they start with."""
    p = plan(spark, sf_dir)
    same = F.substring_index("dp", "-", 1) == F.substring_index("dp", "-", -1)
    scored = (
        p.found.join(p.vocabulary, "id")
        .groupBy("a", "b", "label")
        .agg((F.sum(F.when(same, F.col("n")).otherwise(0)) / F.sum("n")).alias("score"))
        .withColumn("prediction", F.col("score") > 0.5)
    )
    return with_prior(assign_folds(scored))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), 6).alias(f.name) if f.dataType.typeName() == "double" else f.name
            for f in df.schema.fields
        ]
    )


def folds(spark, sf_dir):
    return _rounded(rule_predictions(spark, sf_dir))


def cv_summary(spark, sf_dir):
    return _rounded(evaluate.summary(rule_predictions(spark, sf_dir)))


def cv_class_details(spark, sf_dir):
    return _rounded(evaluate.class_details(rule_predictions(spark, sf_dir)))


def cv_weighted_average(spark, sf_dir):
    return _rounded(evaluate.weighted_average(rule_predictions(spark, sf_dir)))


def confusion_counts(spark, sf_dir):
    return evaluate.confusion_counts(rule_predictions(spark, sf_dir))


def confusion_samples(spark, sf_dir):
    return evaluate.confusion_samples(rule_predictions(spark, sf_dir))


def _trained(classifier: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        return evaluate.class_details(plan(spark, sf_dir).predictions(classifier))

    return query


def naive_bayes_predictions(spark, sf_dir):
    return _rounded(plan(spark, sf_dir).predictions("naive_bayes"))


def naive_bayes_class_details(spark, sf_dir):
    """Over scores of six digits, so that equal ones are equal in any order of sums."""
    predictions = plan(spark, sf_dir).predictions("naive_bayes")
    predictions = predictions.withColumn("score", F.round("score", 6))
    return _rounded(evaluate.class_details(predictions))


def tree_nodes(spark, sf_dir):
    """The upper two levels of every fold's tree, with the nodes they end in."""
    nodes = plan(spark, sf_dir).trees(models=ModelOptions(max_depth=2))
    return nodes.withColumn("gain", F.round("gain", 9))


def tree_predictions(spark, sf_dir):
    """Pairs with their label and the prediction of the tree that did not see them."""
    return _rounded(plan(spark, sf_dir).predictions("decision_tree"))


def tree_summary(spark, sf_dir):
    return _rounded(evaluate.summary(plan(spark, sf_dir).predictions("decision_tree")))


def tree_class_details(spark, sf_dir):
    return _rounded(evaluate.class_details(plan(spark, sf_dir).predictions("decision_tree")))


def logistic_gradient(spark, sf_dir):
    """Weights of every fold's logistic model and the gradient over its training rows."""
    return plan(spark, sf_dir).linear_models("logistic").gradient()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_arcs": parsed,
    "reject_arcs": rejected,
    "stem_vocabulary": stem_vocabulary,
    "stem_arcs": stemmed,
    "head_graph": head_graph,
    "noun_pairs": noun_pairs,
    "noun_pairs_first_half": noun_pairs_first_half,
    "path_records": records,
    "path_records_first_half": records_first_half,
    "reject_arcs_long": reject_arcs_long,
    "head_graph_long": head_graph_long,
    "path_records_long": path_records_long,
    "path_formats": path_formats,
    "path_cells": path_cells,
    "path_support": path_support,
    "frequent_paths": frequent_paths,
    "frequent_word_paths": frequent_word_paths,
    "routed_lines": routed_lines,
    "merged_corpora": merged_corpora,
    "path_ids": path_ids,
    "vector_size": vector_size,
    "max_by_key": max_by_key,
    "kept_records": kept_records,
    "numbered_pairs": numbered_pairs,
    "legacy_text_records": legacy_text_records,
    "label_rows": label_rows,
    "labelled_pairs": labelled_pairs,
    "labelled_pairs_without_conflicts": labelled_pairs_without_conflicts,
    "label_join": label_join,
    "labels_without_evidence": labels_without_evidence,
    "pair_path_counts": pair_path_counts,
    "pair_path_counts_directed": pair_path_counts_directed,
    "dense_cells": dense_cells,
    "labeled_vectors": labeled_vectors,
    "labeled_vectors_compatible": labeled_vectors_compatible,
    "arff_lines": arff_lines,
    "arff_roundtrip": arff_roundtrip,
    "sparse_arff_lines": sparse_arff_lines,
    "sparse_arff_roundtrip": sparse_arff_roundtrip,
    "arff_bytes": arff_bytes,
    "resumed_vectors": resumed_vectors,
    "tsv_roundtrip": tsv_roundtrip,
    "text_corpus": text_corpus,
    "folds": folds,
    "cv_summary": cv_summary,
    "cv_class_details": cv_class_details,
    "cv_weighted_average": cv_weighted_average,
    "confusion_counts": confusion_counts,
    "confusion_samples": confusion_samples,
    "tree_predictions": tree_predictions,
    "tree_summary": tree_summary,
    "tree_class_details": tree_class_details,
    "tree_nodes": tree_nodes,
    "binned_tree_class_details": _trained("binned_tree"),
    "naive_bayes_predictions": naive_bayes_predictions,
    "naive_bayes_class_details": naive_bayes_class_details,
    "logistic_class_details": _trained("logistic"),
    "logistic_gradient": logistic_gradient,
    "linear_svc_class_details": _trained("linear_svc"),
}
