"""Parent-child links to full hierarchies: paths, depths, roots, descendants and the classes that run in circles.

1. Classes are numbered in the order of their IRIs; everything below works on numbers.
2. Upward and downward processing: a class without children, or without parents, left is processed, layer by layer as
   long as layers take much. Then up to ``LOCAL_LINKS`` links (their number is counted) are solved in one task. More are
   contracted: chains of classes with one child and one parent are not walked; pointers along them double until they
   reach the chain's end, and the chain becomes one link. A tree of any depth is thus done in as many rounds as the
   logarithm of its size. Classes never processed reveal the cycles: a chain that closes on itself is one, a link from a
   class to itself after contraction is another, and what can be neither processed nor contracted goes through
   forward-backward colouring. Contracted chains get the component of their ends back in reverse order.
3. Cycles count as one component; every component takes the least IRI of its parents, which makes a forest.
4. Subtree sizes, depths and roots come from doubling: in round k a node adds the sums of those nodes whose 2^k-th
   ancestor it is. Siblings get preorder ranges by prefix sums (in bins of bounded size), which are added up downward,
   again by doubling.
5. Ranges answer the rest: descendants are the nodes within a range, ancestors the ranges around a node. The links to
   further parents carry the range of their lower end to all classes above their upper end, and so on; preorder ranges
   are nested or disjoint, so the descendants of a class are a set of disjoint ranges and are counted without listing.

Link tables are only ever joined on classes; nothing is gathered on the driver but row counts.

Defined results: surrounding blanks are trimmed and ``kbo:`` expanded; null or blank parents say only that the class
exists; repeated links count once; parents without a row of their own are classes too; a class on a cycle has the
least IRI of the cycle as its ``component`` and the position of that component; empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from terrace.functions.text import strip_space
from terrace.runtime import cut, cut_counting, drop_cut

PREFIXES = {"kbo:": "http://kb.example/ontology/"}
BIN_ROWS = 100_000
CHUNK = 4096
LOCAL_LINKS = 200_000


def full_iri(value: Column) -> Column:
    x = strip_space(value)
    out = F.when(x == "", F.lit(None))
    for short, long in PREFIXES.items():
        out = out.when(x.startswith(short), F.concat(F.lit(long), F.substring(x, len(short) + 1, 1 << 20)))
    return out.otherwise(x)


def links(parents: DataFrame) -> DataFrame:
    """Distinct links ``c`` (class), ``p`` (parent)."""
    return parents.select(full_iri(F.col("cls")).alias("c"), full_iri(F.col("parent")).alias("p")).filter("c is not null and p is not null").distinct()


def all_classes(classes: DataFrame, parents: DataFrame) -> DataFrame:
    named = classes.select(full_iri(F.col("cls")).alias("cls"))
    linked = parents.select(F.explode(F.array(full_iri(F.col("cls")), full_iri(F.col("parent")))).alias("cls"))
    return named.union(linked).filter("cls is not null").distinct()


def _replace(old: DataFrame | None, new: DataFrame) -> DataFrame:
    out = cut(new)
    if old is not None:
        drop_cut(old)
    return out


@dataclass
class Graph:
    """``names``: id, cls, ids in the order of the classes; ``edges``: c, p as ids, distinct."""

    names: DataFrame
    edges: DataFrame


def numbered(up: DataFrame, classes: DataFrame | None = None) -> Graph:
    every = up.select(F.explode(F.array("c", "p")).alias("cls"))
    every = (every.union(classes.select("cls")) if classes is not None else every).distinct()
    names = cut(every.orderBy("cls").select(F.monotonically_increasing_id().alias("id"), "cls"))
    to = lambda k: names.select(F.col("id").alias(f"{k}_id"), F.col("cls").alias(k))
    edges = up.join(to("c"), "c").join(to("p"), "p").select(F.col("c_id").alias("c"), F.col("p_id").alias("p"))
    return Graph(names, cut(edges))


# ---------------------------------------------------------------- cycles


def _degrees(edges: DataFrame) -> tuple[DataFrame, dict]:
    """``node``, ``ups``, ``downs``, ``up`` (its parent, if there is just one)."""
    end = lambda node, up, down: F.struct(F.col(node).alias("node"), up.alias("up"), down.alias("down"))
    none = F.lit(None).cast("bigint")
    ends = edges.select(F.explode(F.array(end("c", F.col("p"), none), end("p", none, F.col("c")))).alias("e")).select("e.*")
    deg = ends.groupBy("node").agg(F.count("up").alias("ups"), F.count("down").alias("downs"), F.max("up").alias("up"))
    return cut_counting(deg, chains=F.count_if(F.expr("ups = 1 and downs = 1")), dead=F.count_if(F.expr("ups = 0 or downs = 0")))


def _along_chains(chain: DataFrame) -> DataFrame:
    """``node``, ``far`` (the class above its chain), ``top`` (the chain's highest class), ``low`` (least class from
    here on), ``moving`` (the chain has no end: it is a cycle and ``low`` its least class). ``chain``: node, up."""
    step = chain.select("node", F.col("up").alias("far"), F.col("node").alias("top"), F.col("node").alias("low"), F.lit(True).alias("moving"), F.lit(False).alias("lower"))

    def double(t: DataFrame) -> DataFrame:
        ahead = t.select(F.col("node").alias("far"), F.col("far").alias("_far"), F.col("top").alias("_top"), F.col("low").alias("_low"), F.lit(True).alias("_there"))
        on = F.col("_there").isNotNull()
        return t.join(ahead, "far", "left").select(
            "node", F.coalesce("_far", "far").alias("far"), F.coalesce("_top", "top").alias("top"), F.least("low", "_low").alias("low"), on.alias("moving"),
            (F.col("lower") | F.coalesce(F.col("_low") < F.col("low"), F.lit(False))).alias("lower"),
        )

    table, before = None, -1
    while True:
        nxt, seen = cut_counting(double(double(step)), moving=F.count_if(F.expr("moving")), lower=F.count_if(F.expr("moving and lower")))
        if table is not None:
            drop_cut(table)
        table, n = nxt, seen["moving"]
        if n == 0 or (n == before and seen["lower"] == 0):
            return table
        before, step = n, table.withColumn("lower", F.lit(False))


def _colour(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` of the strongly connected components of two classes or more, by colouring."""
    spark, found = edges.sparkSession, None
    left = edges
    while left.limit(1).count():
        nodes = left.select(F.explode(F.array("c", "p")).alias("node")).distinct()
        colour, changed = cut(nodes.select("node", F.col("node").alias("colour"))), 1
        while changed:
            down = left.join(colour.select(F.col("node").alias("p"), "colour"), "p").groupBy(F.col("c").alias("node")).agg(F.min("colour").alias("_in"))
            nxt = colour.join(down, "node", "left").select("node", F.least("colour", "_in").alias("colour"), F.coalesce(F.col("_in") < F.col("colour"), F.lit(False)).alias("_moved"))
            nxt, seen = cut_counting(nxt, moved=F.count_if(F.expr("_moved")))
            drop_cut(colour)
            colour, changed = nxt.select("node", "colour"), seen["moved"]
        same = (
            left.join(colour.select(F.col("node").alias("c"), F.col("colour").alias("cc")), "c")
            .join(colour.select(F.col("node").alias("p"), F.col("colour").alias("pc")), "p")
        )
        inner = cut(same.filter("cc = pc").select("c", "p", F.col("cc").alias("colour")))
        reached, n, before = cut(colour.filter("node = colour").select("node", "colour")), 0, -1
        while n != before:
            ahead = inner.join(reached.select(F.col("node").alias("c"), "colour"), ["c", "colour"]).select(F.col("p").alias("node"), "colour")
            more, seen = cut_counting(reached.union(ahead).distinct(), n=F.count("*"))
            drop_cut(reached)
            reached, before, n = more, n, seen["n"]
        comp = reached.select("node", F.col("colour").alias("component"))
        found = comp if found is None else found.union(comp)
        left = cut(inner.join(reached.select(F.col("node").alias("c")), "c", "left_anti").join(reached.select(F.col("node").alias("p")), "p", "left_anti").select("c", "p"))
    if found is None:
        return spark.createDataFrame([], "node bigint, component bigint")
    return cut(found.groupBy("component").agg(F.count("*").alias("n")).filter("n > 1").select("component").join(found, "component").select("node", "component"))


def _contracted(left: DataFrame) -> DataFrame:
    spark = left.sparkSession
    closed = spark.createDataFrame([], "node bigint, component bigint")
    log = []
    while True:
        deg, seen = _degrees(left)
        if not seen["chains"] and not seen["dead"]:
            break
        dead = deg.filter("ups = 0 or downs = 0").select("node")
        chain = _along_chains(deg.filter("ups = 1 and downs = 1").select("node", "up")) if seen["chains"] else None
        kind = deg.select("node", (F.col("ups") * F.col("downs") == 0).alias("dead"), F.expr("ups = 1 and downs = 1").alias("chain"))
        rest = left.join(kind.select(F.col("node").alias("c"), F.col("dead").alias("c_dead"), F.col("chain").alias("c_chain")), "c").filter("not c_dead and not c_chain")
        rest = rest.join(dead.select(F.col("node").alias("p")), "p", "left_anti")
        if chain is None:
            rest = rest.select("c", "p", F.lit(None).cast("bigint").alias("top"))
        else:
            closed = closed.union(chain.filter("moving").select("node", F.col("low").alias("component")))
            ends = chain.filter("not moving").select(F.col("node").alias("p"), "far", "top")
            rest = rest.join(ends, "p", "left").select("c", F.coalesce("far", "p").alias("p"), "top").join(dead.select(F.col("node").alias("p")), "p", "left_anti").select("c", "p", "top")
        rest, seen = cut_counting(rest, n=F.count("*"), chains=F.count("top"))
        if seen["chains"]:
            log.append((chain.filter("not moving").select("node", "top"), rest.filter("top is not null")))
        left = rest.filter("c <> p").select("c", "p").distinct()
        if not seen["n"]:
            break
    found = _colour(left).union(closed) if seen.get("n", 1) else closed
    for members, ends in reversed(log):
        name = lambda k: found.select(F.col("node").alias(k), F.col("component").alias(f"{k}_comp"))  # noqa: B023, E731
        own = lambda k: F.coalesce(F.col(f"{k}_comp"), F.col(k))
        back = ends.join(name("c"), "c", "left").join(name("p"), "p", "left").filter(own("c") == own("p"))
        inner = back.select(F.col("top"), F.col("c"), own("c").alias("component"), F.col("c_comp").isNull().alias("fresh"))
        first = inner.filter("fresh").select(F.col("c").alias("node"), "component").distinct()
        found = cut(found.union(first).union(members.join(inner.select("top", "component").distinct(), "top").select("node", "component")))
    return found


def _unprocessed(edges: DataFrame) -> tuple[DataFrame, int]:
    """Links left by processing from the leaves up and from the roots down, as long as two layers of both take a
    quarter of the links or more; then only long chains and cycles keep the rest together."""

    def layer(left: DataFrame) -> DataFrame:
        return left.join(left.select(F.col("p").alias("c")), "c", "left_semi").join(left.select(F.col("c").alias("p")), "p", "left_semi").select("c", "p")

    left, n = edges, edges.count()
    while n:
        nxt, seen = cut_counting(layer(layer(left)), n=F.count("*"))
        if left is not edges:
            drop_cut(left)
        left, before, n = nxt, n, seen["n"]
        if 4 * n > 3 * before:
            break
    return left, n


def _in_one_task(frames):
    """Strongly connected components of the links of one partition, of two classes or more."""
    import numpy as np
    import pandas as pd

    up: dict[int, list[int]] = {}
    for pdf in frames:
        for c, p in zip(pdf["c"].tolist(), pdf["p"].tolist()):
            up.setdefault(c, []).append(p)
            up.setdefault(p, [])
    index: dict[int, int] = {}
    low: dict[int, int] = {}
    stack: list[int] = []
    open_: set[int] = set()
    rows: list[tuple[int, int]] = []
    for start in up:
        work = [] if start in index else [(start, iter(up[start]))]
        while work:
            node, ahead = work[-1]
            if node not in index:
                index[node] = low[node] = len(index)
                stack.append(node)
                open_.add(node)
            for nxt in ahead:
                if nxt not in index:
                    work.append((nxt, iter(up[nxt])))
                    break
                if nxt in open_:
                    low[node] = min(low[node], index[nxt])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == index[node]:
                    at = len(stack) - 1
                    while stack[at] != node:
                        at -= 1
                    part = stack[at:]
                    del stack[at:]
                    open_.difference_update(part)
                    if len(part) > 1:
                        least = min(part)
                        rows += [(x, least) for x in part]
    yield pd.DataFrame(np.array(rows, dtype=np.int64).reshape(-1, 2), columns=["node", "component"])


def components(edges: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """``node``, ``component`` for every class on a cycle; a class linked to itself alone is its own component.

    ``edges``: c, p as numbers. The component is named by its least class. Up to ``local_links`` unprocessed links are
    solved in one task, more by contraction, with the same result.
    """
    spark = edges.sparkSession
    alone = edges.filter("c = p").select(F.col("c").alias("node"))
    left, n = _unprocessed(edges.filter("c <> p"))
    if n == 0:
        return alone.select("node", F.col("node").alias("component"))
    if n <= local_links:
        found = left.repartition(1).mapInPandas(_in_one_task, "node bigint, component bigint")
    else:
        found = _contracted(left)
    least = found.groupBy("component").agg(F.min("node").alias("least"))
    named = found.join(least, "component").select("node", F.col("least").alias("component"))
    single = alone.join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return cut(named.union(single))


def cyclic_classes(parents: DataFrame) -> DataFrame:
    """``cls``: the classes that can be reached from themselves."""
    g = numbered(links(parents))
    return components(g.edges).join(g.names.withColumnRenamed("id", "node"), "node").select("cls")


# ---------------------------------------------------------------- forest, ranges


def _doubled(table: DataFrame, step, rounds: int = 2) -> DataFrame:
    """``step`` applied until no node has a pointer ``far`` left, ``rounds`` times per written table."""
    while True:
        new = table
        for _ in range(rounds):
            new = step(new)
        new, seen = cut_counting(new, open=F.count("far"))
        drop_cut(table)
        table = new
        if not seen["open"]:
            return table


def _sizes(t: DataFrame) -> DataFrame:
    ahead = t.select(F.col("node").alias("far"), F.col("far").alias("_far"), F.col("depth").alias("_depth"), F.col("root").alias("_root"))
    below = t.filter("far is not null").groupBy(F.col("far").alias("node")).agg(F.sum("size").alias("_size"))
    joined = t.join(ahead, "far", "left").join(below, "node", "left")
    return joined.select(
        "node", "up", F.col("_far").alias("far"), (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"), F.coalesce("_root", "root").alias("root"),
        (F.col("size") + F.coalesce("_size", F.lit(0))).alias("size"),
    )


def _starts(t: DataFrame) -> DataFrame:
    ahead = t.select(F.col("node").alias("far"), F.col("far").alias("_far"), F.col("pre").alias("_pre"))
    keep = [c for c in t.columns if c not in ("far", "pre")]
    return t.join(ahead, "far", "left").select(*keep, F.col("_far").alias("far"), (F.col("pre") + F.coalesce("_pre", F.lit(0))).alias("pre"))


def _points(ranges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``pre`` for every number in ``lo`` to ``hi``. A long range is cut into chunks that are spread first."""
    some = ranges.filter("lo <= hi").select(*keys, F.explode(F.sequence("lo", "hi", F.lit(CHUNK).cast("bigint"))).alias("lo"), "hi")
    spread = some.withColumn("hi", F.least(F.col("hi"), F.col("lo") + (CHUNK - 1))).repartition("lo")
    return spread.select(*keys, F.explode(F.sequence("lo", "hi")).alias("pre"))


def _around(ranges: DataFrame, points: DataFrame, nodes: int) -> DataFrame:
    """Rows of ``ranges`` (lo, hi, ...) with rows of ``points`` (pt, ...) that lie within.

    A range is the union of few aligned blocks, whose number is the logarithm of its length; a point lies in one block
    of each size. Equal blocks meet, and every pair meets just once.
    """
    top = max(1, int(nodes).bit_length())
    low, high = "shiftright(lo + shiftleft(1L, k) - 1, k)", "shiftright(hi + 1, k)"
    block = lambda test, at: f"if({low} < {high} and {test} % 2 = 1, named_struct('k', k, 'i', {at}), null)"
    blocks = f"filter(flatten(transform(sequence(0, {top}), k -> array({block(low, low)}, {block(high, high + ' - 1')}))), x -> x is not null)"
    left = ranges.withColumn("b", F.explode(F.expr(blocks))).select("*", "b.k", "b.i").drop("b")
    right = points.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(top)))).withColumn("i", F.expr("shiftright(pt, k)"))
    return left.join(right, ["k", "i"]).drop("k", "i")


def _closed(steps: DataFrame) -> DataFrame:
    """Transitive closure of ``a``, ``b`` by doubling: as many rounds as the logarithm of the longest way."""
    all_, seen = cut_counting(steps, n=F.count("*"))
    before = -1
    while seen["n"] and seen["n"] != before:
        before = seen["n"]
        hop = all_.join(all_.select(F.col("a").alias("b"), F.col("b").alias("_b")), "b").select("a", F.col("_b").alias("b"))
        nxt, seen = cut_counting(all_.union(hop).distinct(), n=F.count("*"))
        drop_cut(all_)
        all_ = nxt
    return all_


@dataclass
class Hierarchy:
    """``nodes``: cls, component, in_cycle, depth, root, pre and last (preorder range: the descendants in the forest are
    those with pre in (pre, last]), n_below (by all links).
    ``forest``: node, up, depth, root, pre, last, name of each component.
    ``further``: node, lo, hi: the ranges a component reaches by further parents alone, disjoint from its own.
    """

    nodes: DataFrame
    forest: DataFrame
    further: DataFrame

    def paths(self) -> DataFrame:
        """``component``, ``path``: the components from the root down, by the ranges around each."""
        f = self.forest
        pairs = _points(f.select("depth", "name", (F.col("pre") + 1).alias("lo"), F.col("last").alias("hi")), ["depth", "name"])
        above = pairs.groupBy("pre").agg(F.sort_array(F.collect_list(F.struct("depth", "name"))).alias("a"))
        up = F.transform("a", lambda x: x["name"])
        return f.join(above, "pre", "left").select(F.col("name").alias("component"), F.concat(F.coalesce(up, F.array().cast("array<string>")), F.array("name")).alias("path"))


def build(classes: DataFrame, parents: DataFrame) -> Hierarchy:
    g = numbered(links(parents), all_classes(classes, parents))
    comp = components(g.edges)
    every = g.names.join(comp.withColumnRenamed("node", "id"), "id", "left")
    every = cut(every.select("id", "cls", F.coalesce("component", "id").alias("node"), F.col("component").isNotNull().alias("in_cycle")))
    to = lambda k: every.select(F.col("id").alias(k), F.col("node").alias(f"{k}_node"))
    lifted = g.edges.join(to("c"), "c").join(to("p"), "p").filter("c_node <> p_node").select(F.col("c_node").alias("c"), F.col("p_node").alias("p")).distinct()
    lifted = cut(lifted)
    # components form no cycle, so any choice of one parent makes a forest
    chosen = lifted.groupBy(F.col("c").alias("node")).agg(F.min("p").alias("up"))
    start = every.filter("id = node").select("node").join(chosen, "node", "left")
    start = start.select("node", "up", F.col("up").alias("far"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint").alias("depth"), F.coalesce("up", "node").alias("root"), F.lit(1).cast("bigint").alias("size"))
    first, seen = cut_counting(start, n=F.count("*"))
    sized = _doubled(first, _sizes).drop("far")
    # siblings: prefix sums within bins, then over the bins of a parent
    bins = max(1, -(-seen["n"] // BIN_ROWS))
    sized = sized.withColumn("bin", F.pmod(F.xxhash64("node"), F.lit(bins)))
    within = sized.withColumn("before", F.sum("size").over(W.partitionBy("up", "bin").orderBy("node").rowsBetween(W.unboundedPreceding, -1)))
    totals = sized.groupBy("up", "bin").agg(F.sum("size").alias("total"))
    over = totals.withColumn("base", F.sum("total").over(W.partitionBy("up").orderBy("bin").rowsBetween(W.unboundedPreceding, -1))).select(F.col("up").alias("_up"), F.col("bin").alias("_bin"), "base")
    at = F.coalesce("before", F.lit(0)) + F.coalesce("base", F.lit(0)) + F.when(F.col("up").isNull(), 0).otherwise(1)
    placed = within.join(over, F.col("up").eqNullSafe(F.col("_up")) & (F.col("bin") == F.col("_bin"))).select("node", "up", F.col("up").alias("far"), "depth", "root", "size", at.alias("pre"))
    placed = _doubled(cut(placed), _starts)
    name = every.filter("id = node").select("node", F.col("cls").alias("name"))
    roots = name.select(F.col("node").alias("root"), F.col("name").alias("root_name"))
    forest = placed.join(name, "node").join(roots, "root").select("node", "up", "depth", F.col("root_name").alias("root"), "pre", (F.col("pre") + F.col("size") - 1).alias("last"), "size", "name")
    forest = cut(forest)
    further = cut(_further(lifted, forest, seen["n"]))
    more = further.groupBy("node").agg(F.sum(F.col("hi") - F.col("lo") + 1).alias("more"))
    nodes = (
        every.join(forest, "node").join(more, "node", "left")
        .select("cls", F.col("name").alias("component"), "in_cycle", "depth", "root", "pre", "last", (F.col("size") - 1 + F.coalesce("more", F.lit(0))).alias("n_below"))
    )
    return Hierarchy(nodes, forest, further)


def _further(lifted: DataFrame, forest: DataFrame, nodes: int) -> DataFrame:
    """``node``, ``lo``, ``hi``: disjoint ranges below a component that only links to further parents reach."""
    extra = lifted.join(forest.select(F.col("node").alias("c"), F.col("up").alias("p")), ["c", "p"], "left_anti")
    places = extra.join(forest.select(F.col("node").alias("p"), F.col("pre").alias("pt")), "p").select("c", "pt")
    ranges = forest.select(F.col("node").alias("a"), F.col("pre").alias("lo"), F.col("last").alias("hi"))
    base = cut(_around(ranges, places, nodes).select("a", F.col("c").alias("b")).distinct())
    on = _closed(base.join(extra.select(F.col("c").alias("a")).distinct(), "a", "left_semi").select("a", "b"))
    reach = base.union(base.join(on.select(F.col("a").alias("b"), F.col("b").alias("_b")), "b").select("a", F.col("_b").alias("b"))).distinct()
    of = lambda k: forest.select(F.col("node").alias(k), F.col("pre").alias(f"{k}_pre"), F.col("last").alias(f"{k}_last"))
    outside = reach.join(of("a"), "a").join(of("b"), "b").filter("b_pre < a_pre or b_pre > a_last")
    earlier = F.max("b_last").over(W.partitionBy("a").orderBy("b_pre", F.desc("b_last")).rowsBetween(W.unboundedPreceding, -1))
    return outside.withColumn("_earlier", earlier).filter("_earlier is null or b_pre > _earlier").select(F.col("a").alias("node"), F.col("b_pre").alias("lo"), F.col("b_last").alias("hi"))


def descendants(h: Hierarchy) -> DataFrame:
    """``component``, ``below``: every pair of components of which the second lies below the first by any links.

    The ranges of a component are disjoint, so each pair comes out once.
    """
    own = h.forest.select("node", (F.col("pre") + 1).alias("lo"), F.col("last").alias("hi"))
    pairs = _points(own.union(h.further.select("node", "lo", "hi")), ["node"])
    below = h.forest.select("pre", F.col("name").alias("below"))
    return pairs.join(below, "pre").join(h.forest.select("node", F.col("name").alias("component")), "node").select("component", "below")


def contained(h: Hierarchy) -> DataFrame:
    """``component``, ``below``: whose range lies within whose, by comparing ranges only."""
    inner = h.forest.select(F.col("pre").alias("pt"), F.col("name").alias("below"))
    outer = h.forest.select(F.col("name").alias("component"), (F.col("pre") + 1).alias("lo"), F.col("last").alias("hi")).filter("lo <= hi")
    pairs = _around(outer, inner, h.forest.count())
    return pairs.select("component", "below")
