"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings (term, document, position) of the training
texts; lists of terms that no test text has are left out.  ``phrase_hits``
takes the windows of the test texts, picks in each window the positions of its
rarest terms (by postings counted over all documents), moves their lists by the
offset in the test text so that an occurrence gives the same shift in each, and
intersects: only (document, test text, shift) groups that hold all the rare
terms of a window are candidates.  A candidate's words are then counted one by
one: the words of documents with candidates become rows (document, position,
term), the candidates' windows too, and a candidate of which every word meets
its row is an occurrence.  That is linear in the words and in the candidates.
``proximity_matches`` intersects the lists of the two rarest terms of a window
with a slack instead.

Only DataFrame functions.  The test side is broadcast when its counted size is
under ``BROADCAST_BYTES`` and joined by a shuffle otherwise; the rows and their
results are the same either way.  Only documents that share a cell of a hash
with a candidate are shuffled, for the check; the set of cells is bounded and
broadcast.
A document is known by 128 bits of hash of id and text (``KEY``), so rows equal
in both are searched once.

Defined cases: null and empty texts have no words; test texts shorter than a
window are one window; test texts without words never match; equal test texts
are searched once and all their ids listed, equal windows of one test text are
one; repeated documents get equal results; an empty benchmark leaves every
document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.llm.common import ascii_lower, read_table
from lapse.session import materialize

GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"      # what stands between words; the test side has the same rule
WINDOW = 10
RAREST = 2
BROADCAST_BYTES = 16 << 20
KEY = ["dkey", "dkey2"]
CELLS = 1 << 20             # cells of the broadcast set that tells most documents apart before a shuffle


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def _small(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with a broadcast hint if its counted bytes are few."""
    size = df.agg(F.sum(sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in columns),
                            F.lit(0)))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def test_texts(items: DataFrame, item: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct word lists (tid, words), and which items have them (item, tid)."""
    split = items.select(F.col(item).alias("item"), words(F.col(text)).alias("words")).where("size(words) > 0")
    texts = materialize(split.select("words").distinct()
                        .withColumn("tid", F.monotonically_increasing_id()), "testtexts")
    return texts, split.join(texts, "words").select("item", "tid")


def with_key(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.withColumns({"dkey": F.xxhash64(F.col(key), F.col(text)), "dkey2": F.xxhash64(F.lit(1), F.col(key), F.col(text))})


def vocabulary(texts: DataFrame) -> DataFrame:
    """The numbered terms (term, term_id) of the test texts; the empty term stands for a document's end."""
    terms = texts.select(F.explode("words").alias("term")).union(texts.sparkSession.sql("SELECT '' AS term"))
    return materialize(terms.distinct().withColumn("term_id", F.monotonically_increasing_id()), "vocabulary")


def build_index(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Stored postings (term_id, KEY, pos) of documents that carry ``KEY``; the empty term's position is the length."""
    ended = F.concat(words(F.col(text)), F.array(F.lit("")))
    postings = docs.select(*KEY, F.posexplode(ended).alias("pos", "term")).join(_small(terms, ["term"]), "term")
    return materialize(postings.select("term_id", *KEY, "pos"), "postings")


def test_windows(texts: DataFrame, terms: DataFrame, index: DataFrame, size: int = WINDOW) -> DataFrame:
    """Windows (tid, at, n) with their rarest positions ``rare``; those with an unseen term can't occur and go."""
    found = index.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    split = texts.select("tid", F.size("words").alias("total"), F.posexplode("words").alias("off", "term"))
    counted = split.join(terms, "term").join(found, "term_id", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    first = F.greatest(F.lit(0), F.col("off") - (size - 1))
    last = F.least(F.col("off"), F.greatest(F.lit(0), F.col("total") - size))
    covered = counted.withColumn("at", F.explode(F.sequence(first, last)))
    rank = Window.partitionBy("tid", "at").orderBy("df", "off")
    ranked = covered.withColumn("r", F.row_number().over(rank))
    windows = (ranked.groupBy("tid", "at")
               .agg(F.count(F.lit(1)).cast("int").alias("n"), F.min("df").alias("least"),
                    F.sort_array(F.collect_list(F.when(F.col("r") <= RAREST, F.struct("off", "term_id")))).alias("rare"),
                    F.sort_array(F.collect_list(F.struct("off", "term"))).alias("placed"))
               .where("least > 0").withColumn("phrase", F.col("placed")["term"]).drop("least", "placed"))
    # of equal windows of a test text the first stands for all: they occur at the same places
    return windows.groupBy("tid", "phrase").agg(F.min_by(F.struct("at", "n", "rare"), "at").alias("w")).select("tid", "w.*", "phrase")


def candidates(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(KEY, tid, at, n, start): places where the shifted lists of a window's rarest terms meet.

    The offsets that meet at a shift are kept as bits; in test texts of over 64
    words bits are shared, which only adds candidates.
    """
    bit = lambda off: F.call_function("shiftleft", F.lit(1).cast("long"), off)
    rare = windows.select("tid", F.explode("rare").alias("x")).select("tid", "x.off", "x.term_id").distinct()
    shifted = (index.join(_small(rare, ["tid", "off", "term_id"]), "term_id")
               .select(*KEY, "tid", (F.col("pos") - F.col("off")).alias("shift"), "off"))
    met = shifted.groupBy(*KEY, "tid", "shift").agg(F.bit_or(bit(F.col("off"))).alias("have"))
    needs = windows.select("tid", "at", "n", F.aggregate(
        "rare", F.lit(0).cast("long"), lambda s, r: s.bitwiseOR(bit(r["off"]))).alias("need"))
    # a shift with one rare term is of use only to texts with a window of one
    fewest = needs.groupBy("tid").agg(F.min(F.bit_count("need")).alias("fewest"))
    return (met.join(_small(fewest, ["tid", "fewest"]), "tid").where("bit_count(have) >= fewest")
            .join(needs, "tid").where(F.col("have").bitwiseAND(F.col("need")) == F.col("need"))
            .select(*KEY, "tid", "at", "n", (F.col("shift") + F.col("at")).alias("start"))
            .where("start >= 0"))


def _cells(keys: DataFrame) -> DataFrame:
    """The cells that the keys fall into: ``CELLS`` numbers at most, whatever the keys."""
    return F.broadcast(keys.select(F.pmod("dkey", F.lit(CELLS)).alias("cell")).distinct())


def _maybe(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` in a cell of ``keys`` (or, with ``left_anti``, in none), without a shuffle."""
    cells = _cells(keys)
    return docs.join(cells, F.pmod(docs["dkey"], F.lit(CELLS)) == cells["cell"], how)


def phrase_hits(docs: DataFrame, texts: DataFrame, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Every exact window in ``docs`` (KEY and text) as (KEY, tid, start, n), and (KEY, n_words) of all documents."""
    terms = vocabulary(texts)
    index = build_index(docs, terms)
    windows = materialize(test_windows(texts, terms, index, size), "windows")
    found = materialize(candidates(index, windows), "candidates")
    phrases = windows.select("tid", "at", F.posexplode("phrase").alias("i", "term"))
    wanted = (found.join(_small(phrases, ["tid", "at", "i", "term"]), ["tid", "at"])
              .select(*KEY, "tid", "at", "n", "start", (F.col("start") + F.col("i")).alias("pos"), "term"))
    keys = materialize(found.select(*KEY).distinct(), "suspects")
    some = _maybe(docs.select(*KEY, "text"), keys).join(keys, KEY, "left_semi").dropDuplicates(KEY)
    rows = some.select(*KEY, F.posexplode(words(F.col("text"))).alias("pos", "term"))
    met = wanted.join(rows, [*KEY, "pos", "term"]).groupBy(*KEY, "tid", "at", "start", "n").agg(F.count(F.lit(1)).alias("met"))
    hits = materialize(met.where("met = n").select(*KEY, "tid", "start", "n"), "hits")
    lengths = (index.join(F.broadcast(terms.where("term = ''")), "term_id")     # one term
               .groupBy(*KEY).agg(F.max("pos").cast("long").alias("n_words")))
    return hits, lengths


def proximity_matches(docs: DataFrame, texts: DataFrame, slack: int, size: int = WINDOW) -> DataFrame:
    """(KEY, tid, at): windows whose two rarest terms stand in a document at most ``slack`` words
    nearer or farther than in the window.

    Shifts are cut into cells of ``slack + 1``; a partner is in the same cell or a neighbour.
    """
    terms = vocabulary(texts)
    index = build_index(docs, terms)
    windows = materialize(test_windows(texts, terms, index, size), "windows")
    pair = windows.where(F.size("rare") == 2).select(
        "tid", "at", F.col("rare")[0].alias("a"), F.col("rare")[1].alias("b"))

    def lists(which: str) -> DataFrame:
        side = pair.select("tid", "at", f"{which}.off", f"{which}.term_id")
        return index.join(_small(side, ["tid", "at", "off", "term_id"]), "term_id").select(
            *KEY, "tid", "at", (F.col("pos") - F.col("off")).alias(f"shift_{which}"))

    cell = lambda c: F.floor(F.col(c) / F.lit(slack + 1))
    left = lists("a").withColumn("cell", cell("shift_a"))
    right = lists("b").withColumn("cell", F.explode(F.array(*[cell("shift_b") + d for d in (-1, 0, 1)])))
    return (left.join(right, [*KEY, "tid", "at", "cell"])
            .where(F.abs(F.col("shift_a") - F.col("shift_b")) <= slack)
            .select(*KEY, "tid", "at").distinct())


def drop_contaminated(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no window of a test text occurs, unchanged."""
    hits, _ = phrase_hits(with_key(docs.select("doc_id", "text")), test_texts(items)[0], size)
    rows = with_key(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")).drop("doc_id", "text")
    bad = materialize(hits.select(*KEY).distinct(), "contaminated")
    kept = _maybe(rows, bad, "left_anti").unionByName(_maybe(rows, bad).join(bad, KEY, "left_anti"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and matching benchmark items of every document."""
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate(docs, items)


def decontaminate(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs`` (doc_id, text)."""
    texts, _ = test_texts(items)
    keyed = with_key(docs.select("doc_id", "text"))
    hits, lengths = phrase_hits(keyed, texts, size)
    covered = (hits.select(*KEY, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos")).distinct()
               .groupBy(*KEY).agg(F.count(F.lit(1)).alias("n_hit")))
    have = items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
    named = have.join(texts, "words").select("item", "tid").where("item IS NOT NULL").distinct()
    lists = (hits.select(*KEY, "tid").distinct().join(named, "tid")
             .groupBy(*KEY).agg(F.sort_array(F.collect_set("item")).alias("items")))
    found = materialize(covered.join(lists, KEY, "left"), "contamination")
    items_of = F.coalesce("items", F.expr("CAST(array() AS array<string>)"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return keyed.drop("text").join(lengths, KEY).join(found, KEY, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items_of).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
         array_to_string(list_slice(w, s + 1, s + least(len(w), 10)), ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS s FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT rid, n, s, array_to_string(list_slice(w, s + 1, s + n), ' ') AS phrase
  FROM (SELECT rid, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT rid, s, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.phrase = bw.phrase),
cov AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT rid, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT rid, s, n FROM hit)) GROUP BY rid),
its AS (
  SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (rid) LEFT JOIN its USING (rid)
"""
