"""Separate surfaces for features, labels and what only an evaluation may see, kept apart by the lineage of columns.

Names prove nothing: a label that was renamed, joined in again or folded into an aggregate is still one.  So a frame of
features is checked on its analysed plan, in which every output is traced to the source columns that it stems from.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame


def _each(seq) -> Iterator:
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _source(node) -> str:
    """What a leaf of the plan reads: files by their folders, other relations by what they are made of."""
    kind = _kind(node)
    if kind == "LogicalRelation":
        return node.relation().location().rootPaths().mkString(",")
    if kind == "LogicalRDD":
        return f"rdd {node.rdd().id()}"
    return node.simpleStringWithNodeId() if kind != "LocalRelation" else f"local {node.schema().catalogString()} {node.data().hashCode()}"


def _aliases(expression) -> Iterator:
    if _kind(expression) == "Alias":
        yield expression
    for child in _each(expression.children()):
        yield from _aliases(child)


def stems(df: DataFrame) -> dict[str, set[tuple[str, str]]]:
    """Per output column the (source, column) pairs that its values are computed from.

    Filters and join conditions choose rows and are not traced.  What a plan node makes without saying how, such as a
    function in Python, stems from all that it reads.
    """
    made: dict[int, set[int]] = {}
    leaves: dict[int, tuple[str, str]] = {}
    plan = df._jdf.queryExecution().analyzed()
    todo = [plan]
    while todo:
        node = todo.pop()
        children = list(_each(node.children()))
        todo += children
        outputs = [(a.exprId().id(), a.name()) for a in _each(node.output())]
        if not children:
            source = _source(node)
            leaves.update({i: (source, name) for i, name in outputs})
            continue
        read = [[a.exprId().id() for a in _each(c.output())] for c in children]
        for expression in _each(node.expressions()):
            for alias in _aliases(expression):
                made.setdefault(alias.exprId().id(), set()).update(a.exprId().id() for a in _each(alias.references()))
        if _kind(node) in ("Union", "Intersect", "Except"):
            for k, (i, _) in enumerate(outputs):
                made.setdefault(i, set()).update(ids[k] for ids in read if ids[k] != i)
            continue
        below = {i for ids in read for i in ids}
        named = _kind(node) == "Generate" and {a.exprId().id() for a in _each(node.generator().references())}
        for i, _ in outputs:
            if i not in below and i not in made:
                made[i] = named or below

    def closure(start: int) -> set[tuple[str, str]]:
        seen, todo, out = set(), [start], set()
        while todo:
            i = todo.pop()
            if i not in seen:
                seen.add(i)
                todo += made.get(i, ())
                if i in leaves:
                    out.add(leaves[i])
        return out

    found: dict[str, set[tuple[str, str]]] = {}
    for a in _each(plan.output()):
        found.setdefault(a.name(), set()).update(closure(a.exprId().id()))
    return found


class LeakError(ValueError):
    """A feature stems from a column that features must not see."""


def features_only(features: DataFrame, forbidden: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """``features``, unless a column of it stems from one of the ``forbidden`` columns, such as results or closing prices.

    A forbidden column is named by a frame and a column of it; all source columns that it stems from count.
    """
    barred = {s for frame, column in forbidden for s in stems(frame)[column]}
    bad = {name: sorted({c for _, c in found & barred}) for name, found in stems(features).items() if found & barred}
    if bad:
        raise LeakError("; ".join(f"{name} stems from {', '.join(columns)}" for name, columns in sorted(bad.items())))
    return features


def surfaces(rows: DataFrame, key: Sequence[str], features: Sequence[str], labels: Sequence[str], forbidden: Sequence[tuple[DataFrame, str]]) -> tuple[DataFrame, DataFrame]:
    """Two frames with the key: the features, checked, and the labels.  What is in neither list is in no frame."""
    return features_only(rows.select(*key, *features), forbidden), rows.select(*key, *labels)
