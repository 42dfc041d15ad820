"""Document fingerprints by SpotSigs: chains of content words that follow common words."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import components, let, stored, whole_text

# Common words of English, German, French and Spanish, the anchors.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or our she that the their "
    "there they this to was we were what which who will with would you "
    "aber als am auch auf aus bei bin das dass dem den der des die ein eine einem einen einer es für hat ich ihr im ist "
    "mit nach nicht noch nur oder sein sich sie sind so über um und uns von war wenn wie wir zu zum zur "
    "au aux avec ce ces cette comme dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou "
    "où par pas plus pour qu que qui sa se ses son sont sur un une vous "
    "al como con del desde e el ella ellos entre era esta este esto fue hay las lo los más me mi muy no nos o para pero "
    "por porque se sin sobre su sus también te tu una uno y ya"
).split()
#: Content words in a chain after its anchor.
CHAIN = 3
#: So many content words without an anchor among them, and the next one begins a chain by itself.
FAR = 8


def signatures(text: Column) -> Column:
    """The text's set of chains as distinct 64-bit hashes, in ascending order.

    A content word right after an anchor begins a chain of CHAIN content words, anchors in
    between left out; so does one with no anchor among the FAR words before it, so that lists
    and texts without common words have chains too. A text with words but no chain is one
    signature by itself; only the empty text has none.
    """
    lowered = F.lower(text)

    def of_words(words: Column) -> Column:
        def of_contents(at: Column) -> Column:
            def chain(p, k):
                after_anchor = (p > 0) & F.when(k == 0, True).otherwise(F.get(at, k - 1) < p - 1)
                far = F.when(k < FAR, p == k).otherwise(p - F.get(at, k - FAR) == FAR)
                contents = [F.get(words, F.get(at, k + i)) for i in range(1, CHAIN)]
                start = F.get(words, p)
                return F.when(after_anchor, F.xxhash64(F.get(words, p - 1), start, *contents)).when(
                    far, F.xxhash64(F.lit(""), start, *contents)
                )

            return F.array_distinct(F.filter(F.transform(at, chain), lambda h: h.isNotNull()))

        contents = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda i: ~F.get(words, i).isin(ANCHORS))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(words) > 0, let(contents, of_contents)).otherwise(none)

    words = F.array_remove(F.split(lowered, r"[^\p{L}\p{N}]+"), "")
    whole = F.when(F.length(text) > 0, F.array(F.xxhash64(lowered))).otherwise(F.array().cast("array<bigint>"))
    return let(let(words, of_words), lambda s: F.when(F.size(s) > 0, F.sort_array(s)).otherwise(whole))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets; 1 for two empty sets."""
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(
        let(shared, lambda n: n / (F.size(a) + F.size(b) - n))
    )


def written(signature_set: Column) -> Column:
    """The fingerprint: the signatures in hexadecimal digits, one after another."""
    return F.array_join(F.transform(signature_set, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def next_ids(ids: DataFrame) -> DataFrame:
    """(doc_id, next_id) for every different doc_id: the next larger one, after the last the first.

    Ids are sorted by range; only each range's first id meets the others in one task.
    """
    ranged = ids.where("doc_id is not null").distinct().repartitionByRange("doc_id")
    parts = stored(ranged.withColumn("part", F.spark_partition_id()), "spotsigs-ids")
    firsts = parts.groupBy("part").agg(F.min("doc_id").alias("first"))
    by_part = Window.orderBy("part")
    lowest = F.min("first").over(Window.partitionBy())
    onward = firsts.select("part", F.coalesce(F.lead("first").over(by_part), lowest).alias("onward"))
    inside = F.lead("doc_id").over(Window.partitionBy("part").orderBy("doc_id"))
    found = parts.withColumn("inside", inside).join(onward, "part")
    return stored(found.select("doc_id", F.coalesce("inside", "onward").alias("next_id")), "spotsigs-next")


def with_next_text(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text) for every row of ``docs``.

    Of rows that repeat a doc_id the smallest text counts as the next one's; a null doc_id is
    followed by the first document. The texts are shuffled by id once, an exchange that both
    joins use, and once more to where they come next; ids are shuffled by themselves.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    order = next_ids(rows.select("doc_id"))
    texts = rows.where("doc_id is not null")
    if not texts.groupBy("doc_id").count().where("count > 1").isEmpty():
        texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))
    followers = order.join(texts, order["next_id"] == texts["doc_id"]).select(
        order["doc_id"].alias("before"), F.col("text").alias("next_text")
    )
    own = rows.where("doc_id is not null")
    named = own.join(followers, own["doc_id"] == followers["before"]).drop("before")
    if rows.where("doc_id is null").isEmpty():
        return named
    first = texts.orderBy("doc_id").limit(1).select(F.col("text").alias("first_text"))
    lone = rows.where("doc_id is null").join(first, how="left")
    return named.unionByName(
        lone.select("doc_id", "text", F.coalesce("first_text", "text").alias("next_text"))
    )


def edited(text: Column, following: Column) -> Column:
    """The last quarter of the text, rounded down, replaced by the first as much of another."""
    chars = F.length(text)
    quarter = F.floor(chars / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), chars - quarter), F.substring(following, F.lit(1), quarter))


def compare_edits(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row.

    Null text counts as empty: no signature, an empty fingerprint, likeness 1 to another empty
    one and 0 to any other. Equal texts have equal fingerprints. Extra columns are ignored.
    """
    rows = with_next_text(docs).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    sets = rows.withColumns(
        {"own": signatures(F.col("text")), "changed": signatures(F.col("edited")), "following": signatures(F.col("next_text"))}
    )
    return sets.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


# -- near-duplicates over all documents ---------------------------------------------------


def length_partition(size: Column, threshold: float) -> Column:
    """Sets of likeness ``threshold`` or more lie in the same partition of lengths or in neighbours."""
    return F.floor(F.log(size) / -math.log(threshold) + 1e-9).cast("int")


def similar_classes(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(membership, pairs): documents by signature set, and different sets that are alike.

    membership: (doc_id, class_id), class_id the smallest doc_id with an equal set. pairs: (a, b,
    likeness) of class ids with likeness at or above ``threshold``. Sets meet only in partitions
    of similar length, on signatures of their prefix, the rarest of a set that must hold a
    shared one; pairs whose lengths rule them out are pruned before sets are compared. Empty
    sets form a class without pairs.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), signatures(whole_text()).alias("sigs"))
    sets = stored(rows.withColumn("key", F.sha2(written(F.col("sigs")), 256)), "spotsigs-sets")
    firsts = sets.groupBy("key").agg(F.min("doc_id").alias("class_id"), F.first("sigs").alias("sigs"))
    firsts = stored(firsts, "spotsigs-classes")
    membership = sets.select("doc_id", "key").join(firsts.select("key", "class_id"), "key").drop("key")
    own = firsts.where("class_id is not null and size(sigs) > 0").select("class_id", "sigs", F.size("sigs").alias("n"))
    counts = own.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count(F.lit(1)).alias("df"))
    ranked = own.select("class_id", "n", F.explode("sigs").alias("sig")).join(stored(counts, "spotsigs-counts"), "sig")
    by_rarity = Window.partitionBy("class_id").orderBy("df", "sig")
    prefix = (
        ranked.withColumn("place", F.row_number().over(by_rarity))
        .where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
        .where("df > 1")
        .select("class_id", "n", "sig", length_partition(F.col("n"), threshold).alias("part"))
    )
    prefix = stored(prefix, "spotsigs-prefix")
    near = F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part")
    left = prefix.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), "sig", near)
    right = prefix.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), "sig", "part")
    may_be = (
        left.join(right, ["sig", "part"])
        .where("a <> b and n_a <= n_b")
        .where(F.col("n_a") >= threshold * F.col("n_b") - 1e-9)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    may_be = stored(may_be, "spotsigs-candidates")
    pairs = may_be.join(own.select(F.col("class_id").alias("a"), F.col("sigs").alias("of_a")), "a").join(
        own.select(F.col("class_id").alias("b"), F.col("sigs").alias("of_b")), "b"
    )
    like = pairs.select("a", "b", likeness(F.col("of_a"), F.col("of_b")).alias("likeness"))
    return membership, like.where(F.col("likeness") >= threshold)


def near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, component_id): documents connected by likeness of ``threshold`` or more."""
    membership, pairs = similar_classes(docs, threshold)
    member = components(pairs.select("a", "b"), "spotsigs")
    joined = membership.join(member, membership["class_id"] == member["node"], "left")
    return joined.select("doc_id", F.coalesce("component", "class_id").alias("component_id"))
