"""SpotSigs document fingerprints, in DataFrame functions alone."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fanflow.llm.common import written
from fanflow.llm.components import components

#: Common words of English, French, German and Spanish that a signature may follow.
ANCHORS = (
    "a an and are as at be by for from has have he in is it its of on or that the this to was were will with "
    "au aux avec ce dans de des du elle en est et il la le les ne nous ou par pas pour que qui sa se sur un une "
    "als auch auf aus bei das dem den der die ein eine er für hat ich im ist mit nicht sich sie und von wie zu zum "
    "al como con del el ella es los las lo más no para pero por si sin son su sus una y"
).split()
#: Content words of a chain.
CHAIN = 2
#: Sets of one signature that give all their pairs; more give stars first.
FEW = 16
#: Small hashes by which sets are compared before whole sets are.
RANGES = 2**16
#: Which share of the texts tells what signatures are common, how often there, and how many; sets that are sent to all tasks by hash.
SAMPLED, SEEN, COMMON, SENT = 32, 3, 2048, 500_000
#: Documents of a range of ids; bounds that are looked up; most ranges.
RANGE, BOUNDS, MOST_RANGES = 1000, 64, 100_000


def words(text: str) -> str:
    """SQL for the lower-cased runs of letters and digits of a text expression."""
    return f"filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), x -> x <> '')"


def spot_signatures(text: str, anchors: tuple[str, ...] = tuple(ANCHORS), chain: int = CHAIN) -> Column:
    """Distinct signatures of a text column, sorted: each anchor with the next chain content words, and ^ with the text's first ones.

    Content words are those that are no anchors. A chain that the text's end cuts is shorter; anchors that no content
    word follows give none. A null, empty or wordless text has no signature. Every array is bound once as a lambda's
    variable, so that no element evaluates it again.
    """
    common = ", ".join(f"'{a}'" for a in dict.fromkeys(anchors))
    follow = ", ".join(f"get(w, get(p, j + {n}))" for n in range(1, chain))
    first = ", ".join(f"get(w, get(p, {n}))" for n in range(chain))
    spots = f"""flatten(transform(p, (k, j) -> if(k - coalesce(get(p, j - 1), -1) > 1,
        transform(slice(w, coalesce(get(p, j - 1), -1) + 2, k - coalesce(get(p, j - 1), -1) - 1), a -> concat_ws(' ', a, w[k]{', ' + follow if follow else ''})),
        cast(array() as array<string>))))"""
    places = f"filter(transform(w, (x, i) -> if(x IN ({common}), -1, i)), i -> i >= 0)"
    start = f"if(size(w) > 0, array(concat_ws(' ', '^', {first})), cast(array() as array<string>))"
    whole = f"transform(array({places}), p -> concat({start}, {spots}))[0]"
    return F.expr(f"array_sort(array_distinct(transform(array({words(f'coalesce({text}, {chr(39)}{chr(39)})')}), w -> {whole})[0]))")


def digest(signatures: str) -> Column:
    """A set of signatures as one string: equal sets have equal digests."""
    return F.md5(F.array_join(signatures, "\n").cast("binary"))


def jaccard(a: str, b: str, least: float = 0.0) -> Column:
    """Jaccard likeness of two sets of signatures, 1 if both are empty; pairs whose sizes rule out least are 0 without being compared."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    return F.when(large == 0, 1.0).when(small < large * least, 0.0).when(small == 0, 0.0).otherwise(shared / (F.size(a) + F.size(b) - shared))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, signatures, fingerprint) of each row's whole text; null texts are empty."""
    return docs.select(id_col, spot_signatures(text_col).alias("signatures")).withColumn("fingerprint", digest("signatures"))


def _commonest(docs: DataFrame) -> Column:
    """Hashes of the commonest signatures, the commonest last, by a count over every SAMPLED-th text: COMMON at most, which only order prefixes."""
    some = docs.filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLED)) == 0).select("text").distinct()
    each = some.select(F.explode(F.transform(spot_signatures("text"), lambda s: F.xxhash64(s))).alias("h"))
    found = each.groupBy("h").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= SEEN).orderBy(F.desc("c"), "h").limit(COMMON).collect()
    return F.from_json(F.lit(str([r.h for r in reversed(found)])), "array<bigint>")


def _hashes(signatures: str) -> Column:
    return F.array_distinct(F.transform(signatures, lambda s: F.xxhash64(s)))


def _prefixes(docs: DataFrame, least: float) -> DataFrame:
    """One row (id, fingerprint, f, t, n, keys, ranges) for each row of docs: hashes of fingerprint and text, of the first of n signatures, and small ones of all.

    In any one order of all signatures, similar sets share one of their first n - ceil(least * n) + 1; here the commonest
    come last.
    """
    common = _commonest(docs)
    sets = docs.select("id", "text", spot_signatures("text").alias("signatures")).withColumn("h", _hashes("signatures"))
    ordered = F.concat(F.sort_array(F.array_except("h", common)), F.array_intersect(common, "h"))
    n = F.size("h")
    small = F.array_distinct(F.transform("h", lambda x: (F.pmod(x, F.lit(RANGES)) - RANGES // 2).cast("smallint")))
    sets = sets.select("id", digest("signatures").alias("fingerprint"), F.xxhash64("text").alias("t"), n.alias("n"), F.slice(ordered, F.lit(1), n - F.ceil(n * least - 1e-9).cast("int") + 1).alias("keys"), small.alias("ranges"))
    return sets.withColumn("f", F.xxhash64("fingerprint"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(f, signatures) of the sets with f in wanted (f, t: hash of a text that has it)."""
    texts = wanted.select("t")
    texts = F.broadcast(texts) if wanted.count() <= SENT else texts
    found = docs.select("text").withColumn("t", F.xxhash64("text")).join(texts, "t", "left_semi").dropDuplicates(["t"])
    return found.select(spot_signatures("text").alias("signatures")).select(F.xxhash64(digest("signatures")).alias("f"), "signatures")


def _verified(pairs: DataFrame, docs: DataFrame, named: DataFrame, least: float) -> DataFrame:
    """Those pairs (a, b) whose signature sets have this Jaccard likeness."""
    pairs = written(pairs.select("a", "b").distinct(), "spots-pairs")
    some = pairs.select(F.col("a").alias("f")).unionByName(pairs.select(F.col("b").alias("f"))).distinct()
    sets = written(_sets(docs, written(named.join(some, "f", "left_semi").select("f", "t"), "spots-wanted")), "spots-sets")
    one, two = (sets.select(F.col("f").alias(c), F.col("signatures").alias(f"set_{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").filter(jaccard("set_a", "set_b", least - 1e-9) >= least - 1e-9).select("a", "b")


def _met(members: DataFrame, least: float, *columns: str) -> DataFrame:
    """Pairs of members of one signature and slot whose sizes allow the likeness: a < b and, for both, the columns."""
    names = ("f", "n", "part", *columns)
    one, two = (members.select("s", "slot", *(F.col(x).alias(c if x == "f" else f"{x}_{c}") for x in names)) for c in "ab")
    fits = (F.col("a") < F.col("b")) & (F.col("slot") == F.greatest("part_a", "part_b")) & (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least - 1e-9)
    return one.join(two, ["s", "slot"]).filter(fits)


def _members(named: DataFrame, least: float) -> DataFrame:
    """(s, slot, f, n, part, size) of each signature hash s of keys that several sets of like length have.

    part is the set's length on a scale where similar sets are in one part or neighbouring ones. Rows of slots part and
    part + 1 let both meet; a pair counts in the greater one's slot alone.
    """
    each = named.select("f", "n", F.explode("keys").alias("s"))
    shared = each.groupBy("s").agg(F.count(F.lit(1)).alias("often")).filter("often > 1").select("s")
    part = F.floor(F.log(F.col("n").cast("double")) / -F.log(F.lit(least)) + 1e-9).cast("int")
    spread = each.join(shared, "s").withColumn("part", part).select("*", F.explode(F.array("part", F.col("part") + 1)).alias("slot"))
    spread = written(spread, "spots-spread")
    groups = spread.groupBy("s", "slot").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return written(spread.join(groups, ["s", "slot"]), "spots-members")


def _parts(sets: DataFrame, crowded: DataFrame, least: float) -> DataFrame:
    """(k, f): keys of parts that sets (f, signatures) of this likeness have in common, given their crowded prefix signatures (f, s).

    Two such sets, the larger of n signatures, differ by d = 2 * n * (1 - least) / (1 + least) of them at most; cut by hash into d + 1 parts,
    one part at least is equal (pigeonhole). A set is cut for its own range of sizes and for the next one. An empty part is
    equal to any other empty one, so its key has a crowded signature besides, which similar sets that meet here share too.
    """
    step = -math.log(least)
    size = F.floor(F.log(F.size("h").cast("double")) / step + 1e-9).cast("int")
    most = F.floor(2 * (F.exp((F.col("slot") + 1) * step) * (1 + 1e-6) + 1) * (1 - least) / (1 + least)) + 1
    each = sets.repartition("f").select("f", _hashes("signatures").alias("h")).filter(F.size("h") > 0)
    each = each.select("f", "h", F.explode(F.array(size, size + 1)).alias("slot")).withColumn("most", most.cast("long"))
    rows = each.select("f", "slot", "most", F.explode("h").alias("x")).withColumn("p", F.pmod("x", "most"))
    full = written(rows.groupBy("f", "slot", "most", "p").agg(F.bit_xor(F.xxhash64("x")).alias("v"), F.count(F.lit(1)).alias("c")), "spots-parts")
    holes = full.groupBy("f", "slot", "most").agg(F.collect_list("p").alias("ps"))
    holes = holes.select("f", "slot", F.explode(F.array_except(F.sequence(F.lit(0).cast("long"), F.col("most") - 1), "ps")).alias("p"))
    none = holes.join(crowded, "f").select(F.xxhash64(F.lit("none"), "slot", "p", "s").alias("k"), "f")
    return full.select(F.xxhash64("slot", "p", "v", "c").alias("k"), "f").unionByName(none)


def _may_be_alike(pairs: DataFrame, counts: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) that counts (f, n, ranges: small hashes of the n signatures) allow: they share the small hashes that both have, and as many more as the lesser number of their signatures that fall together."""
    one, two = (counts.select(F.col("f").alias(c), F.col("n").alias(f"n_{c}"), F.col("ranges").alias(f"ranges_{c}")) for c in "ab")
    more = F.least(F.col("n_a") - F.size("ranges_a"), F.col("n_b") - F.size("ranges_b"))
    shared = F.size(F.array_intersect("ranges_a", "ranges_b")) + more
    return pairs.join(one, "a").join(two, "b").filter(shared >= (F.col("n_a") + F.col("n_b")) * (least / (1 + least)) - 1e-9).select("a", "b")


def _across(large: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs (a, b) across components of members (k, f) of large groups; of groups with the same members one is taken, and the commonest component's rows meet the others' alone."""
    rooted = written(large.select("k", "f").join(roots, "f", "left").withColumn("root", F.coalesce("root", "f")), "spots-rooted")
    groups = rooted.groupBy("k").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count(F.lit(1)).alias("c"), F.bit_xor("f").alias("x"), F.bit_xor(F.xxhash64("f")).alias("y")).filter("least <> most")
    groups = groups.groupBy("c", "x", "y").agg(F.min("k").alias("k")).select("k")
    top = rooted.groupBy("k", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("k").agg(F.max(F.struct("c", "root")).alias("top"))
    rows = written(rooted.join(groups.join(top, "k").select("k", F.col("top.root").alias("top")), "k"), "spots-apart")
    one = rows.filter("root <> top").select("k", F.col("f").alias("a"), F.col("root").alias("root_a"))
    two = rows.select("k", F.col("f").alias("b"), F.col("root").alias("root_b"), "top")
    return one.join(two, "k").filter("root_a <> root_b and (a < b or root_b = top)").select("a", "b").distinct()


def similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.8) -> DataFrame:
    """One row for each row of docs: (id_col, fingerprint, component: the smallest id that links reach).

    Texts of equal fingerprints link, and those whose signature sets have Jaccard likeness of least or more: all of them and
    no others, as far as their components show. Null, empty and wordless texts link with each other only. Null ids stay,
    and a component without any id has none; equal ids are rows of their own; other columns are left out; an empty table
    gives none. Sets are partitioned by length and meet over one of the first of their signatures (see _prefixes()). Groups of a
    signature up to FEW give their pairs, which a bound on what sets can still share prunes: the first signatures that both
    have, the lesser count of crowded ones and the greater rest. Sets of larger groups meet over parts of whole sets instead
    (see _parts()), which unlike sets seldom share however common their signatures are: groups of a part up to FEW give
    their pairs, larger ones stars to their first set; after that only sets of components that are still apart meet in
    them. These pairs are sifted by small hashes, and Jaccard of whole sets decides every link. Sets, texts and
    signatures find each other by 64-bit hashes. docs is read up to four times.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = written(_prefixes(docs, least), "spots-rows")
    named = written(rows.groupBy("f").agg(F.min("id").alias("lowest"), F.min("t").alias("t"), F.any_value("n").alias("n"), F.any_value("keys").alias("keys"), F.any_value("ranges").alias("ranges")), "spots-named")
    members = _members(named, least)
    crowded = members.filter(F.col("size") > FEW)
    hot = crowded.groupBy("f").agg(F.count_distinct("s").alias("hot"))
    few = members.filter(F.col("size") <= FEW).join(hot, "f", "left").na.fill(0, ["hot"])
    shared = _met(few, least, "hot").groupBy("a", "b", "n_a", "n_b", "hot_a", "hot_b").agg(F.count(F.lit(1)).alias("c"))
    most = F.col("c") + F.least("hot_a", "hot_b") + F.ceil(F.greatest("n_a", "n_b") * least - 1e-9) - 1
    likely = shared.filter(most >= (F.col("n_a") + F.col("n_b")) * (least / (1 + least)) - 1e-9).select("a", "b")
    met = likely
    if many := not crowded.isEmpty():
        each = written(crowded.select("f", "s").distinct(), "spots-crowded")
        sets = written(_sets(docs, written(named.join(each.select("f").distinct(), "f", "left_semi").select("f", "t"), "spots-wanted")), "spots-sets")
        cut = _parts(sets, each, least)
        sizes = cut.groupBy("k").agg(F.count(F.lit(1)).alias("size"), F.min("f").alias("lo")).filter("size > 1")
        cut = written(cut.join(sizes, "k"), "spots-cut")
        few, large = cut.filter(F.col("size") <= FEW), cut.filter(F.col("size") > FEW)
        ids = few.groupBy("k").agg(F.array_sort(F.collect_set("f")).alias("ids")).select("ids").distinct()
        both = ids.select(F.explode(F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> struct(x as a, y as b))))")).alias("e")).select("e.a", "e.b")
        star = large.groupBy("f").agg(F.min("lo").alias("lo")).filter("lo < f").select(F.col("lo").alias("a"), F.col("f").alias("b"))
        met = likely.unionByName(both).unionByName(star)
    counts = named.select("f", "n", "ranges")
    near = written(_verified(_may_be_alike(met.distinct(), counts, least), docs, named, least), "spots-near")
    if many and not large.isEmpty():
        roots = written(components(near), "spots-roots").withColumnRenamed("a", "f")
        near = near.unionByName(_verified(_may_be_alike(_across(large, roots), counts, least), docs, named, least))
    roots = written(components(near), "spots-roots").withColumnRenamed("a", "f")
    placed = named.select("f", "lowest").join(roots, "f", "left").withColumn("root", F.coalesce("root", "f"))
    lowest = placed.groupBy("root").agg(F.min("lowest").alias("component"))
    return rows.select("id", "fingerprint", "f").join(placed.join(lowest, "root").select("f", "component"), "f").select(F.col("id").alias(id_col), "fingerprint", "component")


def with_next(docs: DataFrame, id_col: str, columns: list[Column], names: list[str]) -> DataFrame:
    """Rows (id_col, text, columns) of docs with next_<name>: what the row after it in descending id order has; the first follows the last.

    No global sort: ids are cut into ranges of about RANGE rows (quantiles, and even parts of them), each range is sorted by
    itself, and the head of each range is copied to the end of the one before. Null ids come last; equal ids are ordered
    by the text's hash. Ids must be whole numbers.
    """
    rows = docs.select(F.col(id_col).alias("id"), "text")
    count = rows.count()
    bounds = sorted(set(map(int, rows.approxQuantile("id", [k / BOUNDS for k in range(BOUNDS + 1)], 0.002)))) if count else []
    parts = max(1, min(MOST_RANGES, count // RANGE) // BOUNDS)
    if len(bounds) > 1:
        held = F.array(*(F.lit(b).cast("bigint") for b in bounds))
        cell = F.greatest(F.lit(1), F.least(F.lit(len(bounds) - 1), F.size(F.filter(held, lambda b: b <= F.col("id")))))
        low, high = F.element_at(held, cell), F.element_at(held, cell + 1)
        inside = F.floor((F.col("id") - low).cast("double") / (high - low) * parts)
        rank = F.when(F.col("id").isNull(), -1).otherwise(cell * parts + F.greatest(F.lit(0), F.least(F.lit(parts - 1), inside))).cast("bigint")
    else:
        rank = F.when(F.col("id").isNull(), -1).otherwise(0).cast("bigint")
    rows = rows.withColumn("range", rank).withColumn("hash", F.xxhash64("text"))
    heads = rows.groupBy("range").agg(F.min(F.struct(F.col("id").isNull().alias("none"), (-F.col("id").cast("decimal(20,0)")).alias("down"), "hash")).alias("head"))
    down = Window.orderBy(F.col("range").desc())
    top = F.first("head").over(down.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    follow = heads.select(F.col("range").alias("to"), F.coalesce(F.lead("head").over(down), top).alias("head"))
    follow = F.broadcast(follow.select("to", (-F.col("head.down")).cast("bigint").alias("head_id"), F.col("head.hash").alias("head_hash")))
    copies = rows.join(follow, F.col("id").eqNullSafe(F.col("head_id")) & (F.col("hash") == F.col("head_hash")))
    both = rows.select("range", "id", "text", "hash", F.lit(0).alias("copy")).unionByName(copies.select(F.col("to").alias("range"), "id", "text", "hash", F.lit(1).alias("copy")))
    dealt = both.repartition("range").select("*", *(c.alias(n) for c, n in zip(columns, names, strict=True)))
    order = Window.partitionBy("range").orderBy("copy", F.col("id").desc_nulls_last(), "hash")
    nexts = [F.lead(n).over(order).alias(f"next_{n}") for n in ("text", *names)]
    return dealt.select("copy", F.col("id").alias(id_col), "text", *names, *nexts).filter("copy = 0").drop("copy")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", [spot_signatures("text")], ["signatures"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited"), "signatures", "next_signatures")
    rows = rows.withColumn("edited_signatures", spot_signatures("edited"))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digest("signatures").alias("fingerprint"), digest("edited_signatures").alias("edited_fingerprint"), jaccard("signatures", "edited_signatures").alias("near_edited"), jaccard("signatures", "next_signatures").alias("near_next"))


def spotsigs_similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SpotSigs' own join over all documents: doc_id, fingerprint, component_id."""
    return similar(spark.read.parquet(f"{sf_dir}/documents.parquet")).withColumnRenamed("component", "component_id")


_COMMON = ", ".join(f"'{a}'" for a in dict.fromkeys(ANCHORS))
_JACCARD = "CASE WHEN len({a}) + len({b}) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect({a}, {b}))::DOUBLE / (len({a}) + len({b}) - len(list_intersect({a}, {b}))) END"
_SIGNED = f"""w AS (SELECT doc_id, kind, list_filter(string_split_regex(lower(t), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM t),
p AS (SELECT *, list_filter(list_transform(w, lambda x, i: CASE WHEN x IN ({_COMMON}) THEN -1 ELSE i END), lambda i: i > 0) AS p FROM w),
s AS (SELECT doc_id, kind, list_sort(list_distinct(list_concat(
    CASE WHEN len(w) > 0 THEN [concat_ws(' ', '^', w[p[1]], w[p[2]])] ELSE [] END,
    flatten(list_transform(p, lambda k, j: CASE WHEN k - coalesce(p[j - 1], 0) > 1
        THEN list_transform(w[coalesce(p[j - 1], 0) + 1:k - 1], lambda a: concat_ws(' ', a, w[k], w[p[j + 1]])) ELSE [] END))))) AS s FROM p),
"""
OP4_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT doc_id, text, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next_text FROM d),
e AS (SELECT *, substring(text, 1, length(text) - length(text) // 2) || substring(next_text, 1, length(text) // 2) AS edited FROM n),
t AS (SELECT doc_id, 'own' AS kind, text AS t FROM e UNION ALL SELECT doc_id, 'edited', edited FROM e UNION ALL SELECT doc_id, 'next', next_text FROM e),
{_SIGNED}o AS (SELECT doc_id, any_value(s) FILTER (kind = 'own') AS a, any_value(s) FILTER (kind = 'edited') AS b, any_value(s) FILTER (kind = 'next') AS c FROM s GROUP BY doc_id)
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(edited) AS edited_sha256, md5(array_to_string(a, chr(10))) AS fingerprint,
    md5(array_to_string(b, chr(10))) AS edited_fingerprint, {_JACCARD.format(a='a', b='b')} AS near_edited, {_JACCARD.format(a='a', b='c')} AS near_next
FROM e JOIN o USING (doc_id)
"""
SIMILAR_SQL = f"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS doc_id, doc_id AS id, 'own' AS kind, coalesce(text, '') AS t FROM documents),
{_SIGNED}f AS (SELECT doc_id, s, len(s) AS n, md5(array_to_string(s, chr(10))) AS fingerprint FROM s),
c AS (SELECT fingerprint, any_value(s) AS s, any_value(n) AS n FROM f GROUP BY fingerprint),
x AS (SELECT fingerprint, n, unnest(s) AS g FROM c),
l AS (SELECT a.fingerprint AS a, b.fingerprint AS b FROM x a JOIN x b ON a.g = b.g AND a.fingerprint <> b.fingerprint
      GROUP BY a.fingerprint, b.fingerprint, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9),
r AS (SELECT fingerprint AS a, fingerprint AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
m AS (SELECT r.a, min(t.id) AS component_id FROM r JOIN f ON f.fingerprint = r.b JOIN t ON t.doc_id = f.doc_id GROUP BY r.a)
SELECT t.id AS doc_id, fingerprint, component_id FROM t JOIN f USING (doc_id) JOIN m ON m.a = f.fingerprint
"""
