"""Dependency paths between the nouns of a line.

A record ``(dp, a, b)`` says that noun ``b`` is an ancestor of noun ``a`` and
``dp`` is the path up to it. Walking up from every noun meets every ordered pair,
so pairs are never formed.

The first ``unrolled_hops`` hops are plain columns, a few per hop, inside generated
code. A walk that has not ended by then is on a long path or in a cycle and is done
again in array form, which remembers the visited nodes and is bounded by the number
of tokens. So the number of unrolled hops changes the speed and never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..options import Options
from .graph import first_half_bound, with_graph
from .stemming import stem_arcs


def _node_texts(path_format: str) -> tuple[str, str]:
    """Texts of a token ``t`` inside a path and, masked, at its ends."""
    if path_format == "pos":
        return "t.pos", "t.pos"
    tail = "t.label" if path_format == "word_label" else "t.pos, t.label"
    return f"concat_ws('/', t.word, {tail})", f"concat_ws('/', 'X', {tail})"


def _found(path: str, node: str) -> str:
    return f"named_struct('dp', concat({path}, '-', {node}.end), 'b', {node}.word)"


def _is_hit(node: str, options: Options) -> str:
    hit = f"{node}.noun AND {node}.word <> a"
    if options.pair_scope == "first_half":
        hit += f" AND least({node}.at, _start) <= _half"
    return hit


def _any_walk(options: Options) -> str:
    """Hits of one start as an array, whatever the line's length and cycles."""
    node = "get(_nodes, s.up - 1)"
    alive = "s.up > 0 AND NOT array_contains(s.seen, s.up)"
    hop = f"""named_struct(
        'up', CASE WHEN {alive} THEN {node}.up ELSE 0 END,
        'seen', CASE WHEN {alive} THEN concat(s.seen, array(s.up)) ELSE s.seen END,
        'path', CASE WHEN {alive} THEN concat(s.path, '-', {node}.inner) ELSE s.path END,
        'hits', CASE WHEN {alive} AND {_is_hit(node, options)}
            THEN concat(s.hits, array({_found("s.path", node)})) ELSE s.hits END)"""
    begin = """named_struct('up', get(_nodes, _start - 1).up, 'seen', array(_start),
        'path', get(_nodes, _start - 1).end,
        'hits', cast(array() AS array<struct<dp:string,b:string>>))"""
    return f"aggregate(sequence(1, size(_nodes)), {begin}, (s, _) -> {hop}, s -> s.hits)"


def walk_up(
    arcs: DataFrame, options: Options = Options(), formats: list[str] | None = None
) -> DataFrame:
    """Path records ``dp, a, b`` of stemmed lines; other columns are carried along.

    With ``formats`` the records of every one of these path formats, named in ``_format``,
    from one graph of each line.
    """
    rest = [c for c in arcs.columns if c not in ("head", "toks")]
    graphs = with_graph(arcs, options)
    inner, end = _node_texts(options.path_format)
    if formats is not None:
        listed = ", ".join(f"'{f}'" for f in formats)
        several = f"CASE WHEN size(_nouns) > 1 THEN array({listed}) ELSE cast(array() AS array<string>) END"
        graphs = graphs.select("*", F.expr(f"explode({several}) AS _format"))
        rest = [*rest, "_format"]
        texts = [(f, *_node_texts(f)) for f in formats]
        inner = " ".join(f"WHEN '{f}' THEN {text}" for f, text, _ in texts)
        end = " ".join(f"WHEN '{f}' THEN {text}" for f, _, text in texts)
        inner, end = f"CASE _format {inner} END", f"CASE _format {end} END"
    # A self-arc is a dead end like a missing parent.
    nodes = f"""transform(toks, (t, i) -> named_struct(
        'at', i + 1,
        'up', CASE WHEN get(_par, i) <> i + 1 THEN cast(get(_par, i) AS int) ELSE 0 END,
        'noun', get(_noun, i), 'word', t.word, 'inner', {inner}, 'end', {end}))"""
    half = first_half_bound() if options.pair_scope == "first_half" else F.lit(0)
    # A node that occurs twice starts one walk; a root and a lone noun start none.
    starts = """CASE WHEN size(_nouns) > 1
        THEN filter(_nouns, p -> get(_canon, p - 1) = p AND get(_par, p - 1) NOT IN (0, p))
        ELSE cast(array() AS array<int>) END"""
    walk = (
        graphs
        # One projection below the generator: beside it, it would run once per start.
        .select(*rest, F.expr(nodes).alias("_nodes"), half.alias("_half"), "_nouns", "_canon", "_par")
        .select(*rest, "_nodes", "_half", F.expr(f"explode({starts}) AS _start"))
        .withColumn("_node0", F.expr("get(_nodes, _start - 1)"))
    )
    hops = options.unrolled_hops
    for hop in range(hops + 1):
        # The next node, and what this one adds to the path and to the hits.
        columns = {f"_node{hop + 1}": F.expr(f"get(_nodes, _node{hop}.up - 1)")}
        if hop == 0:
            columns |= {"a": F.col("_node0.word"), "_path0": F.col("_node0.end")}
        else:
            found = _found(f"_path{hop - 1}", f"_node{hop}")
            columns[f"_hit{hop}"] = F.expr(
                f"CASE WHEN {_is_hit(f'_node{hop}', options)} THEN {found} END"
            )
            columns[f"_path{hop}"] = F.expr(f"concat(_path{hop - 1}, '-', _node{hop}.inner)")
        walk = walk.withColumns(columns)
    # A walk still on the way after the last column sends its line along instead of
    # its hits: a long path or a cycle. Both kinds of rows leave through one generator,
    # which drops the misses before anything wide is written.
    ended = f"_node{hops + 1} IS NULL"
    line = "named_struct('_nodes', _nodes, '_start', _start, '_half', _half)"
    hits = [f"named_struct('_hit', CASE WHEN {ended} THEN _hit{h} END, '_line', NULL)" for h in range(1, hops + 1)]
    hits.append(f"named_struct('_hit', NULL, '_line', CASE WHEN NOT {ended} THEN {line} END)")
    found = (
        walk.select(*rest, "a", F.expr(f"inline(array({', '.join(hits)}))"))
        .where("_hit IS NOT NULL OR _line IS NOT NULL")
        .select(*rest, "a", "_hit", "_line.*")
    )
    return found.select(
        *rest,
        "a",
        F.expr(f"explode(CASE WHEN _nodes IS NULL THEN array(_hit) ELSE {_any_walk(options)} END) AS _hit"),
    ).select(*rest, F.col("_hit.dp").alias("dp"), "a", F.col("_hit.b").alias("b"))


def line_text(head: Column, toks: Column) -> Column:
    """A line as text: head, tab, blank-separated tokens."""
    token = lambda t: F.concat_ws("/", t["word"], t["pos"], t["label"], t["ptr"])
    return F.concat(head, F.lit("\t"), F.array_join(F.transform(toks, token), " "))


def path_records(
    arcs: DataFrame,
    options: Options = Options(),
    with_line: bool = False,
    formats: list[str] | None = None,
) -> DataFrame:
    """Path records of parsed lines: stem the nouns, then walk up from each.

    ``with_line`` adds the text of the stemmed line, which is wide; leave it out of
    anything that is shuffled. ``formats`` stands for several path formats, see ``walk_up``.
    """
    stemmed = stem_arcs(arcs, options, pairs_only=True)
    if with_line:
        stemmed = stemmed.withColumn("line", line_text(F.col("head"), F.col("toks")))
    return walk_up(stemmed, options, formats)
