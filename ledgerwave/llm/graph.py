"""Links among the members of buckets, and the connected components of links."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.llm.common import written

#: Edges that a task takes when components are sought.
EDGES_OF_A_TASK = 500_000
#: So many members of a bucket are held against all of it at first, see ``tied``.
LEADERS = 16


def is_empty(frame: DataFrame) -> bool:
    return not frame.take(1)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (id, component): the least id of all that an id of some edge is tied to.

    Alternating large and small stars: every node hangs its larger neighbours on the least of them, until each
    component is a star. A node of very many edges is only ever a join key or a least value. There are as many tasks as
    the edges need, so few edges do not cost a task for every shuffle partition.
    """
    at = written(
        edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct(),
        "edges",
    )
    tasks = max(8, at.count() // EDGES_OF_A_TASK)
    while not _stars(at):
        both = at.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            at.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = written(large.coalesce(tasks), "large")
        lowest = written(large.groupBy("hi").agg(F.min("lo").alias("m")).coalesce(tasks), "lowest")
        small = large.join(lowest, "hi").filter("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        both = small.unionByName(lowest.select("hi", F.col("m").alias("lo")))
        at = written(both.distinct().coalesce(tasks), "small")
    roots = at.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return at.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)


def _stars(edges: DataFrame) -> bool:
    """Whether every larger end has one lesser end, and that has none."""
    ends = edges.select(F.col("hi").alias("node"), "lo").unionByName(edges.select(F.col("lo").alias("node"), "lo"))
    return is_empty(ends.groupBy("node").agg(F.min("lo").alias("a"), F.max("lo").alias("b")).filter("a <> b"))


def tied(
    members: DataFrame,
    may: Callable[[Column, Column], Column],
    verify: Callable[[DataFrame], DataFrame],
    rounds: tuple[int, ...] = (LEADERS,),
    last: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """(id, component): the components that all linked pairs of members of a bucket make.

    ``members`` has (bucket, id, mark). A pair is a link if its marks fulfil ``may``, which the join of a bucket asks
    before it makes a row, and ``verify`` keeps it of the pairs (a, b). In each of the ``rounds``, so many least ids of
    each bucket (16 in the only one) are held against its members; they have met all of it then. What that leaves, pairs
    of others in larger buckets, is made only for members of different components: a group of thousands of copies, tied
    to one of its own by then, makes no pairs of its members. Ids without a link are left out. ``last``
    makes the pairs (a, b) of what the rounds leave, of (bucket, id, of), instead of the join; it may leave out pairs of
    one ``of`` and pairs that are no links.
    """
    size = members.groupBy("bucket").agg(F.count("*").alias("size"))
    several = written(size.filter("size > 1").select("bucket"), "several")
    left = written(members.join(several, "bucket").select("bucket", "id", "mark", F.col("id").alias("of")), "met")
    of: DataFrame | None = None
    for many in rounds:
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy("id"))
        lead = left.withColumn("nth", nth).filter(F.col("nth") <= many).drop("nth")
        lead = written(lead.withColumnsRenamed({"id": "a", "mark": "mark_a", "of": "of_a"}), "leaders")
        apart = (F.col("id") > F.col("a")) & (F.col("of") != F.col("of_a"))
        pairs = left.join(lead, "bucket").filter(apart & may(F.col("mark_a"), F.col("mark")))
        of = more(of, verify(written(pairs.select("a", F.col("id").alias("b")).distinct(), "pairs")))
        others = left.join(lead.select("bucket", F.col("a").alias("id")), ["bucket", "id"], "left_anti").drop("of")
        others = others.join(of, "id", "left").select("bucket", "id", "mark", F.coalesce("component", "id").alias("of"))
        others = written(others, "others")
        mixed = others.groupBy("bucket").agg(F.min("of").alias("x"), F.max("of").alias("y")).filter("x <> y")
        left = written(others.join(mixed.select("bucket"), "bucket", "left_semi"), "left")
        if is_empty(left):
            return of
    if last is not None:
        return more(of, verify(written(last(left.select("bucket", "id", "of")).distinct(), "pairs")))
    a, b = (left.withColumnsRenamed({c: f"{c}_{n}" for c in left.columns}) for n in "ab")
    apart = (F.col("id_a") < F.col("id_b")) & (F.col("of_a") != F.col("of_b"))
    rest = a.join(b, (F.col("bucket_a") == F.col("bucket_b")) & apart & may(F.col("mark_a"), F.col("mark_b")))
    return more(of, verify(written(rest.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct(), "pairs")))


def more(of: DataFrame | None, found: DataFrame) -> DataFrame:
    """The components of those before, if any, and of the links found."""
    found = written(found, "links")
    if of is None:
        return written(components(found), "components")
    if is_empty(found):
        return of
    # Found components stand for their links.
    stars = of.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return written(components(stars.unionByName(found)), "components")


def links(
    members: DataFrame,
    measure: Callable[[DataFrame], DataFrame],
    may: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """Links (a, b) that tie together just what all pairs of members of a bucket with a distance of 1 or less would.

    ``members`` has (bucket, id); ``measure`` adds ``d`` to pairs (a, b), a metric, and may leave out pairs beyond 2.
    Not all pairs of a bucket are made. Its least ids lead: one at first, 64 in the second round, 4,096 in the third.
    Each member is measured against the leaders, from the second round on only those that nothing ties to the leader
    yet. A member within 1 of a leader is done, for whoever is near to it is within 2 of the leader. Those between 1
    and 2, unless tied already, are measured against the leader's own members, as far as the distances leave it
    possible (d(a, b) >= d(leader, b) - d(leader, a)). Buckets that are not yet tied as a whole go on to the next round.
    With ``may``, a condition on the ``mark`` that members then have, a bucket's pairs are left out as they are joined if
    their marks tell that they are more than 2 apart.

    So a group of thousands of copies costs a distance for each of them, and a bucket of strangers one for each pair of
    them at worst.
    """
    if may is None:
        members, may = members.withColumn("mark", F.lit(0)), lambda a, b: F.lit(True)
    lead = members.groupBy("bucket").agg(F.min(F.struct("id", "mark")).alias("m"), F.max("id").alias("last"))
    lead = lead.select("bucket", F.col("m.id").alias("leader"), F.col("m.mark").alias("lead_mark"), "last")
    lead = written(lead.filter("leader <> last").drop("last"), "leaders")
    rest = written(members.join(lead.select("bucket"), "bucket", "left_semi").select("bucket", "id", "mark"), "members")
    met = _met(rest, lead, may(F.col("lead_mark"), F.col("mark")))
    found: list[DataFrame] = []
    many = 1
    while True:
        met = written(met, "met")
        pairs = met.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
        measured = written(measure(pairs).select("a", "b", "d"), "measured")
        near = measured.filter("d <= 1")
        found.append(near.select("a", "b"))
        late = _late(measured, found)
        if late is not None:
            found.append(written(measure(late).select("a", "b", "d").filter("d <= 1").select("a", "b"), "late"))
        # Leaders and who has met a near one are done; the others go on, if their bucket is not of one component.
        tied = met.join(near.select(F.col("a").alias("leader"), F.col("b").alias("id")), ["leader", "id"], "left_semi")
        gone = tied.select("bucket", "id").unionByName(lead.select("bucket", F.col("leader").alias("id")))
        of = written(components(_all(found)), "components")
        left = rest.join(gone, ["bucket", "id"], "left_anti").join(of, "id", "left")
        left = written(left.select("bucket", "id", "mark", F.coalesce("component", "id").alias("of")), "left")
        mixed = left.groupBy("bucket").agg(F.min("of").alias("x"), F.max("of").alias("y")).filter("x <> y")
        open_ = written(left.join(mixed.select("bucket"), "bucket", "left_semi"), "rest")
        if is_empty(open_):
            break
        many *= 64
        nth = F.row_number().over(Window.partitionBy("bucket").orderBy("id"))
        first = open_.withColumn("nth", nth).filter(F.col("nth") <= many)
        lead = first.select(
            "bucket", F.col("id").alias("leader"), F.col("mark").alias("lead_mark"), F.col("of").alias("leads")
        )
        lead = written(lead, "leaders")
        met = _met(open_, lead, (F.col("of") != F.col("leads")) & may(F.col("lead_mark"), F.col("mark")))
        rest = open_.select("bucket", "id", "mark")
    return _all(found).distinct()


def _met(rest: DataFrame, lead: DataFrame, condition: Column) -> DataFrame:
    same = rest["bucket"] == lead["bucket"]
    met = rest.join(lead, same & (F.col("id") > F.col("leader")) & condition)
    return met.select(rest["bucket"], "leader", "id")


def _all(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for more in frames[1:]:
        result = result.unionByName(more)
    return result


def _late(measured: DataFrame, found: list[DataFrame]) -> DataFrame | None:
    """Pairs of a leader's near member and one between 1 and 2 from the leader that nothing ties to it yet."""
    between = measured.filter("d > 1 and d <= 2").select(F.col("a").alias("leader"), "b", F.col("d").alias("d_b"))
    near = measured.filter("d <= 1").select(F.col("a").alias("leader"), F.col("b").alias("a"), F.col("d").alias("d_a"))
    reach = (F.col("a") != F.col("b")) & (F.col("d_a") >= F.col("d_b") - 1)
    # Which leaders and others still have somebody to be measured against: their farthest near member tells.
    farthest = near.groupBy("leader").agg(F.max("d_a").alias("most"))
    open_ = written(between.join(farthest, "leader").filter("most >= d_b - 1").select("leader", "b", "d_b"), "open")
    if is_empty(open_):
        return None
    of = written(components(_all(found)), "components")
    own = lambda c: of.select(F.col("id").alias(c), F.col("component").alias(f"of_{c}"))
    tied = F.coalesce(F.col("of_leader") == F.col("of_b"), F.lit(False))
    untied = open_.join(own("leader"), "leader", "left").join(own("b"), "b", "left").filter(~tied)
    pairs = written(
        untied.select("leader", "b", "d_b")
        .join(near, "leader")
        .filter(reach)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "late",
    )
    return None if is_empty(pairs) else pairs
