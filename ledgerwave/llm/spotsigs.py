"""SpotSigs fingerprints: common words as anchors, chains of the content words that follow, pruned Jaccard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwave.llm import graph
from ledgerwave.llm.common import text_of, written

#: Common words of English, German, French and Spanish, fixed values.
ANCHORS = (
    "a an and are as at be by for from in is it of on that the this to was with "
    "das dem den der des die ein eine ist mit nicht sich und von zu "
    "de des du en est et la le les pas pour que qui un une "
    "con del el las lo los no por que se su un una y"
)
#: Content words in a chain; letters of a signature; similarity of a link.
CHAIN, LETTERS, SIMILARITY = 3, 12, 0.8
#: Rows that stand side by side in a block, and blocks at most.
BLOCK_ROWS, BLOCKS = 2000, 1024

_WORDS = sorted(set(ANCHORS.split()))
_ANY = "|".join(_WORDS)


def chains(text: Column, chain: int = CHAIN) -> Column:
    """Every anchor with the content words after it, up to ``chain`` of them or the next common word; one at least."""
    plain = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    pattern = rf"(?<= )(?:{_ANY})(?: (?!(?:{_ANY}) )[^ ]+){{1,{chain}}}(?= )"
    return F.regexp_extract_all(plain, F.lit(pattern), F.lit(0))


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted set of a text's signatures, each some hex letters of a hash of a chain.

    A text without a chain has one signature, of the text itself, so that it is like its equals alone.
    """
    found = F.array_distinct(chains(text, chain))
    found = F.when(F.size(found) > 0, found).otherwise(F.array(F.concat(F.lit("="), text)))
    return F.sort_array(F.array_distinct(F.transform(found, lambda c: F.substring(F.md5(c.cast("binary")), 1, LETTERS))))


def jaccard(a: Column, b: Column, least: float = 0.0) -> Column:
    """Shared signatures over all, of two sets. Below ``least`` it may be 0: sets whose sizes alone keep them apart
    are not looked into."""
    common = F.size(F.array_intersect(a, b))
    exact = common / (F.size(a) + F.size(b) - common)
    if not least:
        return exact
    return F.when(F.least(F.size(a), F.size(b)) < least * F.greatest(F.size(a), F.size(b)), 0.0).otherwise(exact)


def _blocks(docs: DataFrame) -> list:
    """Ids at which blocks of about ``BLOCK_ROWS`` rows begin, in descending order, the greatest first."""
    count, highest = docs.agg(F.count("*"), F.max("id")).first()
    blocks = max(1, min(BLOCKS, count // BLOCK_ROWS))
    if highest is None or blocks == 1:
        return [highest] if count else []
    cuts = docs.agg(F.percentile_approx("id", [i / blocks for i in range(1, blocks)], 100 * blocks)).first()[0]
    return sorted({highest, *cuts}, reverse=True)


def with_next(docs: DataFrame) -> DataFrame:
    """(id, text) with ``block`` and ``tail`` such that by block, tail, descending id and text each row that is no tail
    is followed by the next one of all; the last row of all by the first.

    Rows are cut into blocks at ids that occur. The rows of such an id are sent to the block before as well, as its
    tail. So every row meets the next one although no task sees more than a block.
    """
    heads = _blocks(docs.select("id"))
    if not heads:
        return docs.withColumns({"block": F.lit(0), "tail": F.lit(False)})
    kind = docs.schema["id"].dataType
    array = F.array(*[F.lit(h).cast(kind) for h in heads])
    last = len(heads) - 1
    # Null is less than all ids, so its rows are in the last block.
    own = F.coalesce(F.size(F.filter(array, lambda h: h >= F.col("id"))) - 1, F.lit(last))
    own = F.when(F.col("id").isNull(), F.lit(last)).otherwise(own)
    place = F.col("own")
    is_head = F.col("id").eqNullSafe(F.element_at(array, place + 1))
    before = F.when(place == 0, F.lit(last)).otherwise(place - 1)
    homes = F.when(
        is_head, F.array(F.struct(place.alias("block"), F.lit(False).alias("tail")), F.struct(before.alias("block"), F.lit(True).alias("tail")))
    ).otherwise(F.array(F.struct(place.alias("block"), F.lit(False).alias("tail"))))
    return docs.withColumn("own", own).select("id", "text", F.inline(homes))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they are to each other and to the next one's.

    The edited text has its last floor(n / 2) characters replaced by the first as many, or all, of the next document
    in descending order of id; after the last comes the first. Rows of one id follow each other in the order of their
    texts, null ids come last. A null text is an empty one. An empty table gives no rows. Other columns are not read.
    Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    order = Window.partitionBy("block").orderBy("tail", F.desc_nulls_last("id"), "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, n_chars - int(floor(n_chars / 2)))"), F.substring("next", 1, half))
    return (
        with_next(rows)
        .withColumn("next", F.lead("text").over(order))
        .withColumn("n_chars", F.length("text"))
        .withColumn("edited", F.when(~F.col("tail"), edited))
        .withColumn("own", signatures(F.col("text")))
        .withColumn("changed", F.when(~F.col("tail"), signatures(F.col("edited"))))
        .select("block", "tail", "id", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "changed")
        .withColumn("following", F.lead("own").over(order))
        .filter(~F.col("tail"))
        .select(
            F.col("id").alias(id_column),
            F.col("n_chars").cast("long").alias("n_chars"),
            "edited_sha256",
            F.array_join("own", " ").alias("fingerprint"),
            F.array_join("changed", " ").alias("edited_fingerprint"),
            jaccard(F.col("own"), F.col("changed")).alias("near_edited"),
            jaccard(F.col("own"), F.col("following")).alias("near_next"),
        )
    )


def length_class(size: Column, similar: float = SIMILARITY) -> Column:
    """Sets whose sizes differ by less than ``similar`` are in one class or in two neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / F.log(F.lit(1 / similar)) + 1e-9).cast("int")


def near_duplicates(
    docs: DataFrame, similar: float = SIMILARITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id and ``class_id``, the least id of a connected group of sets with Jaccard similarity of ``similar``.

    Rows of one set are one member. Members are partitioned by the size of their sets. Two sets that are similar enough
    share one of the first n - ceil(similar n) + 1 signatures of each in any one order, so a member is looked for in its
    own partition and the next under those alone. Other cases as in ``fingerprints``.
    """
    rows = docs.select(F.col(id_column).alias("doc_id"), signatures(text_of(text_column)).alias("own"))
    rows = written(rows.withColumn("key", F.md5(F.array_join("own", " ").cast("binary"))), "sets")
    sets = written(
        rows.groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.first("own").alias("own"))
        .withColumn("id", F.monotonically_increasing_id()),
        "distinct",
    )
    size = F.size("own")
    prefix = F.slice("own", F.lit(1), (size - F.ceil(similar * size - 1e-9) + 1).cast("int"))
    kinds = F.array(length_class(size, similar), length_class(size, similar) + 1)
    members = (
        sets.select("id", F.explode(prefix).alias("signature"), kinds.alias("kinds"))
        .select("id", "signature", F.explode("kinds").alias("kind"))
        .select(F.xxhash64("kind", "signature").alias("bucket"), "id")
    )

    def measure(pairs: DataFrame) -> DataFrame:
        a = sets.select(F.col("id").alias("a"), F.col("own").alias("own_a"))
        b = sets.select(F.col("id").alias("b"), F.col("own").alias("own_b"))
        reach = max(0.0, 1 - 2 * (1 - similar))
        near = jaccard(F.col("own_a"), F.col("own_b"), reach)
        far = (1 - near - 1e-9) / (1 - similar)
        return pairs.join(a, "a").join(b, "b").select("a", "b", far.alias("d")).filter("d <= 2")

    tied = written(graph.components(graph.links(members, measure)), "components")
    grouped = sets.join(tied, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = grouped.groupBy("component").agg(F.min("first").alias("class_id"))
    of_key = written(grouped.join(named, "component").select("key", "class_id"), "classes")
    return rows.join(of_key, "key").select(F.col("doc_id").alias(id_column), "class_id")
