"""Trees in Nexus files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EDGES = "file string, tree string, `from` string, `to` string, length double, root int"
_TOKEN = re.compile(r"\s*(?:\[[^\]]*\])*\s*(?:([(),;])|('(?:[^']|'')*'|[^\s(),:;\[\]]+)?(?::\s*([-+0-9.eE]+))?)")


def newick_edges(text: str) -> list[tuple[str, str, float, int]]:
    """(from, to, length, root) of a tree in parentheses, parents before their children; inner nodes without a name are Inner1, Inner2 and so on."""
    stack: list[list[tuple[str, float, list]]] = [[]]
    at, unnamed = 0, 0
    closed: list | None = None
    while at < len(text):
        m = _TOKEN.match(text, at)
        at = max(m.end(), at + 1)
        if m[1] == "(":
            stack.append([])
        elif m[1] == ")":
            if closed is not None:
                stack[-1].append(_named(None, None, closed))
            closed = stack.pop()
        elif m[1] in (",", ";"):
            if closed is not None:
                stack[-1].append(_named(None, None, closed))
                closed = None
            if m[1] == ";":
                break
        elif m[2] or m[3]:
            stack[-1].append(_named(m[2], m[3], closed or []))
            closed = None
    if closed is not None:
        stack[-1].append(_named(None, None, closed))
    out: list[tuple[str, str, float, int]] = []
    todo = [(node, 1) for node in stack[0][:1]]
    while todo:
        (name, _, children), root = todo.pop()
        if children and not name:
            unnamed += 1
            name = f"Inner{unnamed}"
        for k, child in enumerate(children):
            if child[2] and not child[0]:
                unnamed += 1
                children[k] = child = (f"Inner{unnamed}", *child[1:])
            out.append((name, child[0], child[1], root))
        todo += [(child, 0) for child in reversed(children)]
    return out


def _named(name: str | None, length: str | None, children: list) -> tuple[str, float, list]:
    bare = (name or "").strip()
    return bare[1:-1].replace("''", "'") if bare.startswith("'") else bare, float(length) if length else 0.0, children


def newick(edges: list[tuple[str, str, float]]) -> str:
    """A tree in parentheses from its edges (from, to, length), children in the order given."""
    children: dict[str, list[tuple[str, float]]] = {}
    for a, b, length in edges:
        children.setdefault(a, []).append((b, length))
    below = {b for _, b, _ in edges}
    quote = lambda n: n if re.fullmatch(r"[A-Za-z0-9_.|*-]+", n) else "'" + n.replace("'", "''") + "'"
    done: dict[str, str] = {}
    stack = [a for a in children if a not in below][:1]
    while stack:
        node = stack[-1]
        left = [b for b, _ in children.get(node, ()) if b in children and b not in done]
        if left:
            stack += left
            continue
        stack.pop()
        parts = [(done.pop(b) if b in done else quote(b)) + f":{length!r}" for b, length in children[node]]
        done[node] = "(" + ",".join(parts) + ")" + quote(node)
    return (done.popitem()[1] if done else "") + ";"


def read_nexus(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Edges of all trees of Nexus files: file, tree, from, to, length and root (1 for edges of the root). Names that a file translates are put back."""

    def parse(batches):
        import pandas as pd

        for frame in batches:
            rows = []
            for file, text in zip(frame["file"], frame["value"]):
                table = dict(re.findall(r"([^\s,]+)\s+('[^']*'|[^\s,;]+)\s*(?=[,;])", (re.search(r"(?is)\btranslate\b(.*?;)", text) or ["", ""])[1]))
                for name, tree in re.findall(r"(?im)^\s*u?tree\s+\*?\s*([^\s=]+)\s*=\s*([^;]*;)", text):
                    edges = newick_edges(tree)
                    rows += [(file, name, table.get(a, a), table.get(b, b), length, root) for a, b, length, root in edges]
            yield pd.DataFrame(rows, columns=["file", "tree", "from", "to", "length", "root"])

    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return texts.mapInPandas(parse, EDGES)


def write_nexus(edges: DataFrame, path: str, group: str) -> None:
    """A Nexus file for each group, named by it: its tree from the columns from, to and length, edges in the order of `order` if there is such a column."""
    order = [F.col("order")] if "order" in edges.columns else [F.col("from"), F.col("to")]
    held = edges.groupBy(F.col(group).cast("string").alias("group")).agg(F.sort_array(F.collect_list(F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), "from", "to", "length"))).alias("edges"))

    @F.udf("string")
    def text(name, rows):
        return f"#NEXUS\nBegin Trees;\n Tree {re.sub(r'[^A-Za-z0-9_.-]', '_', name)}={newick([(r['from'], r['to'], r['length']) for r in rows])}\nEnd;"

    held.select(text("group", "edges").alias("value"), "group").write.mode("overwrite").partitionBy("group").text(path)
