"""Secret scan: fixed patterns, and character Markov models for random strings.

Two first-order Markov models over ASCII characters are counted from labelled
samples: one of random strings, one of ordinary identifiers.  The samples grow
with the corpus: every document gives random strings (digests of its row in
several alphabets, and the values that the fixed patterns find) and ordinary
ones (its long tokens outside those matches).  The fitted table has 128 x 128
entries whatever the input, so it goes into the plan as a literal.

A token is what the fixed spans leave of a run of token characters.  It is cut
into parts at its glue characters (``+ / _ = -``); of all runs of parts with 16
or more characters, the one with the greatest sum of log-likelihood ratios is
found by a running minimum of the sums before it, and reported when it exceeds
a fixed threshold.  So a secret glued to words is found without the words.

Only DataFrame functions.  Texts are matched once (``match``): the same spans and
tokens give the samples and are scored afterwards, in projections without a
shuffle; samples are pooled before their character pairs are counted.  Positions
come from the lengths of matches and of the gaps between them, in one fold per
list; each fold appends to an array, which copies references (8 bytes a match).

Defined cases: null text counts as empty; a text without matches has empty
spans; columns named base_spans and spans are replaced; tokens of any length are
scored whole; a token gives at most one span of the method, which never overlaps
a fixed span; repeated rows are scanned alike; empty tables give no rows (the
model is then uniform and reports nothing).
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm.common import read_table
from lapse.session import materialize

# The patterns of the base scan; the group that is measured, and its least length.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12)
ACCESS = (r"AKIA[A-Z0-9]+", 0, 18)
HEX = (r"[0-9a-f]{16,}", 0, 16)       # maximal runs: the same as [0-9a-f]+ of 16 or more
BASE = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)]
METHOD = "random"
LEAST = 16              # characters of a stretch that may be reported
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}"
GLUE = ["+", "/", "_", "=", "-"]
SAMPLE = 8              # characters of an ordinary token that is counted
RATIO = 12.0            # natural log of how much likelier the random model must be
SMOOTHING = 0.5
SPAN = "struct<start:int,rank:int,end:int,kind:string>"
PIECE = "struct<start:int,rank:int,end:int,token:string>"
PLACEHOLDER = "[SECRET]"


def _none(kind: str) -> Column:
    """An empty array of ``kind``."""
    return F.filter(F.array(F.lit(None).cast(kind)), lambda x: x.isNotNull())


def _located(text: Column, regex: str, measured: Column | None, least: int, rank: int, kind: str | None) -> Column:
    """Places of the leftmost non-overlapping matches whose measured group is long enough.

    The last field is ``kind``, or the matched text where there is none.
    """
    matches = F.regexp_extract_all(text, F.lit(regex), F.lit(0))
    gaps = F.split(text, regex, -1)
    sizes = F.zip_with(
        F.zip_with(gaps, matches, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("match"))),
        matches if measured is None else measured,
        lambda s, v: F.struct(s["gap"].alias("gap"), s["match"].alias("match"), F.length(v).alias("value")))
    shape = SPAN if kind else PIECE

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        last = F.lit(kind).alias("kind") if kind else x["match"].alias("token")
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), last)
        return F.struct(
            end.alias("at"),
            F.when(x["value"] >= least, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"))

    zero = F.struct(F.lit(0).alias("at"), _none(shape).alias("found"))
    folded = F.aggregate(sizes, zero, step, lambda s: s["found"])
    return F.when(F.size(matches) > 0, folded).otherwise(_none(shape))


def _spans(text: Column, kind: str, rank: int, pattern: tuple[str, int, int]) -> Column:
    """Spans of one fixed pattern."""
    regex, group, least = pattern
    measured = None if group == 0 else F.regexp_extract_all(text, F.lit(regex), F.lit(group))
    return _located(text, regex, measured, least, rank, kind)


def _left_over(tokens: Column, base: Column) -> Column:
    """What the fixed spans leave of the tokens, in order, in one pass over both lists."""
    events = F.sort_array(F.concat(
        F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("rank"), b["end"].alias("end"),
                                             F.lit(None).cast("string").alias("token"))),
        F.transform(tokens, lambda t: F.struct(t["start"].alias("start"), F.lit(1).alias("rank"), t["end"].alias("end"),
                                               t["token"].alias("token")))))

    def piece(rest: Column, start: Column, end: Column) -> Column:
        return F.struct(start.alias("start"), F.lit(1).alias("rank"), end.alias("end"),
                        F.substring(rest["token"], start - rest["start"] + 1, end - start).alias("token"))

    def add(done: Column, one: Column, wanted: Column) -> Column:
        return F.when(wanted, F.concat(done, F.array(one))).otherwise(done)

    def step(state: Column, e: Column) -> Column:
        rest = state["rest"]
        fixed = e["rank"] == 0
        hit = fixed & (e["start"] < rest["end"])                    # null without a rest
        upto = F.when(hit, e["start"]).otherwise(rest["end"])
        leaves = (~fixed | hit) & (rest["start"] < upto)
        begin = F.greatest(F.when(fixed, rest["start"]).otherwise(e["start"]),
                           F.when(fixed, e["end"]).otherwise(state["covered"]))
        cut = F.when(fixed, piece(rest, begin, rest["end"])).otherwise(piece(e, begin, e["end"]))
        fresh = F.when(fixed & ~F.coalesce(hit, F.lit(False)), rest).when(
            begin < F.when(fixed, rest["end"]).otherwise(e["end"]), cut)
        return F.struct(add(state["done"], piece(rest, rest["start"], upto), leaves).alias("done"),
                        fresh.alias("rest"), F.when(fixed, F.greatest(state["covered"], e["end"]))
                        .otherwise(state["covered"]).alias("covered"))

    zero = F.struct(_none(PIECE).alias("done"), F.lit(None).cast(PIECE).alias("rest"), F.lit(0).alias("covered"))
    return F.aggregate(events, zero, step, lambda s: add(s["done"], s["rest"], s["rest"].isNotNull()))


def match(docs: DataFrame, text: str = "text", key: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """The one pass over the texts: ``row`` (the columns of ``keep``, all by default), ``base_spans``, ``tokens``
    (start, end and text) and what the samples need (``digest``, ``values``, ``ordinary``)."""
    body = F.coalesce(F.col(text), F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.col(key).cast("string"), F.length(body).cast("string")), 256) if key else F.lit(None)
    out = docs.select(F.struct(*(keep or docs.columns)).alias("row"), body.alias("_body"),
                      digest.cast("string").alias("digest"))
    base = F.sort_array(F.concat(*[_spans(F.col("_body"), kind, i, p) for i, (kind, p) in enumerate(BASE)]))
    out = out.withColumn("base_spans", base)
    some = F.size("base_spans") > 0
    values = F.concat(*[F.regexp_extract_all("_body", F.lit(p[0]), F.lit(p[1])) for _, p in BASE])
    anything = "|".join(p[0] for _, p in BASE)
    rest = F.when(some, F.regexp_replace("_body", anything, " ")).otherwise(F.col("_body"))
    return out.select(
        "row", "digest", "base_spans",
        _located(F.col("_body"), TOKEN % LEAST, None, LEAST, 1, None).alias("tokens"),
        F.when(some, F.filter(values, lambda v: F.length(v) >= LEAST)).otherwise(F.array().cast("array<string>")).alias("values"),
        F.regexp_extract_all(rest, F.lit(TOKEN % SAMPLE), F.lit(0)).alias("ordinary"))


def codes(token: Column) -> Column:
    """ASCII codes of a token's characters after a start mark (0)."""
    return F.concat(F.array(F.lit(0)), F.transform(F.split(token, ""), lambda c: F.ascii(c)))


def _pairs(token: Column) -> Column:
    c = codes(token)
    return F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: a * 128 + b)


def samples_of(matched: DataFrame) -> DataFrame:
    """(token, random): random strings and ordinary identifiers of all matched documents."""
    digest = F.col("digest")
    made = F.array(
        digest,                                                       # lower-case hex
        F.upper(F.md5(digest)),                                       # upper-case hex
        F.base64(F.unhex(digest)),                                    # letters, digits, + and /
        F.conv(F.substring(digest, 1, 14), 16, 36))                   # upper-case letters and digits
    return (matched.select(F.explode(F.concat(
                F.transform(F.concat(made, "values"), lambda t: F.struct(t.alias("token"), F.lit(True).alias("random"))),
                F.transform("ordinary", lambda t: F.struct(t.alias("token"), F.lit(False).alias("random"))))).alias("s"))
            .select("s.token", "s.random").where("token <> ''"))


def labelled_samples(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(token, random): random strings and ordinary identifiers of all documents."""
    return samples_of(match(docs, text, key))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each character pair, 128 x 128.

    Equal samples are pooled before their pairs are counted.  The counts that
    come to the driver have at most 2 x 128 x 128 rows.
    """
    rows = (samples.groupBy("random", "token").agg(F.count(F.lit(1)).alias("n"))
            .select("random", "n", F.explode(_pairs(F.col("token"))).alias("pair"))
            .where("pair BETWEEN 0 AND 16383")
            .groupBy("random", "pair").agg(F.sum("n").alias("count")).collect())
    seen = {True: [0.0] * 16384, False: [0.0] * 16384}
    for r in rows:
        seen[r["random"]][r["pair"]] += r["count"]
    table = []
    for a in range(128):
        total = {k: sum(v[a * 128:a * 128 + 128]) + 128 * SMOOTHING for k, v in seen.items()}
        for b in range(128):
            like = {k: (v[a * 128 + b] + SMOOTHING) / total[k] for k, v in seen.items()}
            table.append(round(math.log(like[True] / like[False]), 6))
    return table


def _ratios(token: Column, model: list[float]) -> Column:
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    return F.transform(_pairs(token), lambda p: F.get(table, p))


def log_ratio(token: Column, model: list[float]) -> Column:
    """How much likelier the token is under the random model (natural log)."""
    return F.aggregate(_ratios(token, model), F.lit(0.0), lambda s, x: s + x)


def best_stretch(token: Column, model: list[float]) -> Column:
    """(score, start, end) of the run of parts with ``LEAST`` or more characters whose ratios have the greatest sum.

    Parts end before a glue character and start after one.  One pass: the
    sum up to each end, less the least sum up to a start that lies far enough
    before it.  Of equal runs the first to end wins; score is null if there is none.
    """
    glue = F.transform(F.split(token, ""), lambda c: c.isin(GLUE))
    ratios = _ratios(token, model)
    n = F.length(token)
    ends = F.concat(F.slice(glue, 2, n), F.array(F.lit(True)))
    starts = F.concat(F.array_repeat(F.lit(False), LEAST - 1), F.array(F.lit(True)), glue)
    late = F.concat(F.array_repeat(F.lit(0.0), LEAST), ratios)
    chars = F.zip_with(
        F.zip_with(ratios, ends, lambda r, e: F.struct(r.alias("ratio"), e.alias("ends"))),
        F.zip_with(F.slice(late, 1, n), F.slice(starts, 1, n), lambda r, e: F.struct(r.alias("late"), e.alias("starts"))),
        lambda x, y: F.struct(x["ratio"].alias("ratio"), x["ends"].alias("ends"), y["late"].alias("late"), y["starts"].alias("starts")))

    def step(state: Column, x: Column) -> Column:
        at, total, before = state["at"] + 1, state["total"] + x["ratio"], state["before"] + x["late"]
        lower = x["starts"] & (state["low"].isNull() | (before < state["low"]))
        low = F.when(lower, before).otherwise(state["low"])
        low_at = F.when(lower, at - LEAST).otherwise(state["low_at"])
        better = x["ends"] & low.isNotNull() & (state["score"].isNull() | (total - low > state["score"]))
        return F.struct(
            at.alias("at"), total.alias("total"), before.alias("before"), low.alias("low"), low_at.alias("low_at"),
            F.when(better, total - low).otherwise(state["score"]).alias("score"),
            F.when(better, low_at).otherwise(state["start"]).alias("start"),
            F.when(better, at).otherwise(state["end"]).alias("end"))

    no_sum, no_place = F.lit(None).cast("double"), F.lit(None).cast("int")
    zero = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("total"), F.lit(0.0).alias("before"), no_sum.alias("low"),
                    no_place.alias("low_at"), no_sum.alias("score"), no_place.alias("start"), no_place.alias("end"))
    return F.aggregate(chars, zero, step, lambda s: F.struct(s["score"].alias("score"), s["start"].alias("start"), s["end"].alias("end")))


def score(matched: DataFrame, model: list[float]) -> DataFrame:
    """``row``, ``base_spans`` and ``spans`` (arrays of start, rank, end, kind; code points, end exclusive)."""
    free = F.when((F.size("base_spans") > 0) & (F.size("tokens") > 0),
                  _left_over(F.col("tokens"), F.col("base_spans"))).otherwise(F.col("tokens"))
    best = F.transform(F.filter(free, lambda t: F.length(t["token"]) >= LEAST),
                       lambda t: F.struct(t["start"].alias("at"), best_stretch(t["token"], model).alias("best")))
    random = F.transform(F.filter(best, lambda t: t["best"]["score"] > RATIO), lambda t: F.struct(
        (t["at"] + t["best"]["start"]).alias("start"), F.lit(len(BASE)).alias("rank"),
        (t["at"] + t["best"]["end"]).alias("end"), F.lit(METHOD).alias("kind")))
    return matched.select("row", "base_spans", F.sort_array(F.concat("base_spans", random)).alias("spans"))


def scan(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``."""
    out = score(match(docs, text), model)
    own = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("base_spans", "spans")]
    return out.select(*own, "base_spans", "spans")


def redact(docs: DataFrame, model: list[float], text: str = "text", size: str = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by a placeholder; rows without spans stay as they are."""
    return replace(score(match(docs, text), model), text, size)


def redact_trained(docs: DataFrame, text: str = "text", size: str = "n_chars", key: str = "doc_id") -> DataFrame:
    """``redact`` with models of the same documents, whose texts are matched once; rows with their spans are written."""
    matched = materialize(match(docs, text, key), "secrets")
    return replace(score(matched, train(samples_of(matched))), text, size)


def replace(scored: DataFrame, text: str, size: str) -> DataFrame:
    """The rows of a scored frame with a placeholder for every span."""
    body = F.col("row")[text]

    def step(state: Column, s: Column) -> Column:
        fresh = s["start"] >= state["at"]
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], F.substring(body, state["at"] + 1, s["start"] - state["at"]),
                                   F.lit(PLACEHOLDER))).otherwise(state["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate("spans", zero, step, lambda s: F.concat(
        s["out"], F.substring(body, s["at"] + 1, F.length(body))))
    row = scored.schema["row"].dataType
    out = scored.select("row", "spans", F.when(F.size("spans") > 0, clean).otherwise(body).alias("clean"))
    changed = {text: F.col("clean")}
    if size in row.names:
        changed[size] = F.when(F.size("spans") > 0, F.length("clean")).otherwise(F.col("row")[size]).cast(row[size].dataType)
    return out.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in row.names])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the spans of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    # written once, without the texts: the samples and the scores both come from it
    matched = materialize(match(docs, key="doc_id", keep=["doc_id"]), "secrets")
    model = train(samples_of(matched))

    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return score(matched, model).select(
        "row.doc_id", *[count(kind) for kind, _ in BASE], F.sha2(_joined(F.col("base_spans")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"))
