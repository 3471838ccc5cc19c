"""Personal data: fixed patterns, and bootstrapped contextual extraction. DataFrame functions only.

Base spans of four kinds come from regular expressions and a check of each match. They are the seeds
of a bootstrap: an identifier-shaped token (one with a digit or an @, or a run of groups of digits with
blanks, brackets or hyphens in between) has lexical patterns, the one to CONTEXT whole words before it,
however long they or the blanks around them are.
Patterns and instances (whole tokens, and for seeds the whole span; numbers without what separates their
digits) form a bipartite graph. In each of ROUNDS
rounds a pattern's confidence for a kind is the summed score of its instances over their number plus
one, and an instance's score is the noisy-or of its patterns with a confidence of CONFIDENCE and at
least SUPPORT worth of instances; seeds keep score 1. Tokens in the surviving patterns that look like
the pattern's kind (LOOKS, coarser than the fixed patterns and without their checks) are the discovered
spans. Base spans always stay.

Matches are found with the gaps between them: the pieces of a split at the pattern are the gaps, so a
running sum over gap and match lengths gives each match's place in code points. Expressions are
written so that they need time in proportion to the text, also for a single run of millions of
characters: repetitions are possessive, and a run is entered at its first character or where the
last match ended.

Defined cases: a null text is empty and has no spans; repeated rows and ids are documents of their
own; an empty table gives no rows; in find_personal_data() other columns are ignored, in mask() kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_names, settle, table

KINDS = ("email", "ip", "card", "phone")
#: Where a match may begin: at the first character of a run, or right after the last match.
_EDGE = r"(?:(?<![{0}])|\G)"
PATTERNS = {
    "email": _EDGE.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _EDGE.format("0-9") + r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTETS = r"^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){3}$"
#: Characters that end a token; a run of groups of digits; and a token with a digit or an @ in it.
_STOP = r"\s\"'`(){}\[\]<>|,;:="
#: A run has at most as many groups as an identifier has digits, so that a text of numbers isn't read anew from each of them.
_RUN = rf"(?:\+[0-9]++(?:[\x20().-]++[0-9]++){{0,18}}+|(?:\((?=[0-9]++\)[\x20-]?[0-9]))?+[0-9]++(?=[.!?]*+(?:[{_STOP}]|-[0-9]|\z))(?:(?:[\x20-]|\)[\x20-]?|[\x20-]\()[0-9]++(?=[.!?]*+(?:[{_STOP}]|-[0-9]|\z))){{0,18}}+)(?=[.!?]*+(?:[{_STOP}]|\z))"
TOKEN = rf"(?<![^{_STOP}])(?:{_RUN}|[^{_STOP}0-9@]*+[0-9@][^{_STOP}]*+)"
#: What a discovered instance of a kind looks like.
LOOKS = {"email": r"^[^@]++@[^@]++$", "ip": r"^[0-9]++(?:\.[0-9]++){3}(?:/[0-9]++)?$", "card": r"^[0-9]{12,19}$", "phone": r"^\+?[0-9]{7,15}$"}
CONTEXT, ROUNDS, CONFIDENCE, SUPPORT = 3, 3, 0.8, 3.0
#: The last words of a gap, as they stand in the reversed gap; a word of more than LONG_WORD characters counts as its hash.
_LAST_WORDS = rf"\A\s*+(?:\S++\s*+){{0,{CONTEXT}}}+"
LONG_WORD = 64
#: Code points of the blocks that a text is cut into for masking.
_BLOCK = 256


def _matches(text: Column, pattern: str, needs: Column, gap) -> Column:
    """array of (gap before, match); null where the text can't match."""
    found = F.arrays_zip(F.transform(F.split(text, pattern, -1), gap).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    return F.when(needs, found)


def _last_words(gap: Column) -> Column:
    words = F.filter(F.split(F.reverse(F.regexp_extract(F.reverse(gap), _LAST_WORDS, 0)), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.when(F.length(w) > LONG_WORD, F.concat(F.lit("~"), F.hex(F.xxhash64(w)))).otherwise(w)), " ")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column, most: int = 19) -> Column:
    """Whether up to `most` digits pass the Luhn check."""
    back, total = F.reverse(digits), F.lit(0)
    for i in range(most):
        d = F.coalesce(F.substring(back, i + 1, 1).try_cast("int"), F.lit(0))
        total = total + (d if i % 2 == 0 else 2 * d - F.when(d > 4, 9).otherwise(0))
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    n = F.length(_digits(match))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", match.rlike(_OCTETS))
        .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), luhn(_digits(match))).otherwise(False))
        .otherwise(n.between(8, 15))
    )


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(uid, doc_id, key, found, tokens): each document's matches without its text, settled, so that uid holds.

    key is a hash of the text, with which results can be joined to the documents.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(doc_id).cast("long").alias("doc_id"), t.alias("t"))
    t = F.col("t")
    digit = t.rlike("[0-9]")
    needs = {"email": F.contains(t, F.lit("@")), "ip": digit, "card": digit, "phone": F.contains(t, F.lit("+"))}
    found = F.struct(*[_matches(t, PATTERNS[k], needs[k], F.length).alias(k) for k in KINDS])
    tokens = _matches(t, TOKEN, digit | F.contains(t, F.lit("@")), lambda g: F.struct(F.length(g).alias("n"), _last_words(g).alias("tail")))
    return settle(rows.select("uid", "doc_id", F.xxhash64("t").alias("key"), found.alias("found"), tokens.alias("tokens")))


def _placed(rows: DataFrame, gap: str, *by: str) -> DataFrame:
    """Adds start and end to rows of (by, pos, gap, match); the last gap has no match and goes."""
    upto = Window.partitionBy(*by).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("match")
    end = F.sum((F.col(gap) + F.coalesce(size, F.lit(0))).cast("long")).over(upto)
    return rows.withColumn("end", end).where(F.col("match").isNotNull()).withColumn("start", F.col("end") - size)


def base_spans(scanned: DataFrame) -> DataFrame:
    """(uid, kind as a number, start, end, instance)."""
    every = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"found.{k}").alias("m")) for i, k in enumerate(KINDS)])
    rows = scanned.select("uid", F.explode(every).alias("e")).where("e.m is not null and size(e.m) > 1").select("uid", "e.kind", F.posexplode("e.m").alias("pos", "m")).select("uid", "kind", "pos", "m.gap", "m.match")
    placed = _placed(rows, "gap", "uid", "kind")
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return placed.where(_valid(name, F.col("match"))).select("uid", "kind", "start", "end", _instance(F.col("match")).alias("instance"))


def _instance(match: Column) -> Column:
    """A number without what separates its digits; anything else in lower case."""
    number = match.rlike(r"^[+(]?[0-9][\x20().0-9-]*+$") & ~match.rlike(LOOKS["ip"])
    return F.when(number, F.regexp_replace(match, r"[\x20().-]", "")).otherwise(F.lower(match))


def occurrences(scanned: DataFrame, spans: DataFrame) -> DataFrame:
    """(uid, start, end, instance, before, kind): tokens outside of spans, and each span at its first token, with its kind."""
    rows = scanned.where("tokens is not null and size(tokens) > 1").select("uid", F.posexplode("tokens").alias("pos", "m")).select("uid", "pos", "m.gap.n", "m.gap.tail", "m.match")
    tokens = _placed(rows, "n", "uid").withColumn("match", F.rtrim("match", F.lit(".!?"))).withColumn("end", F.col("start") + F.length("match"))
    tokens = tokens.select("uid", "start", "end", "match", "tail", F.lit(None).cast("int").alias("kind"), F.lit(None).cast("string").alias("instance"))
    both = tokens.union(spans.select("uid", "start", "end", F.lit(None).cast("string"), F.lit(None).cast("string"), "kind", "instance"))
    # along a document: how far the spans so far reach, where the last of them began, and the next span
    along = Window.partitionBy("uid").orderBy("start", F.col("match").isNotNull(), "end", "kind")
    span = F.when(F.col("kind").isNotNull(), F.struct("start", "end", "kind", "instance"))
    reach = F.max(F.when(F.col("kind").isNotNull(), F.col("end"))).over(along)
    # the next span is the last one seen from the other end: a growing frame, where a shrinking one would be read anew for each row
    back = Window.partitionBy("uid").orderBy(F.desc("start"), F.desc(F.col("match").isNotNull()), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    last, later = F.last(span, ignorenulls=True).over(along), F.last(span, ignorenulls=True).over(back)
    seen = both.withColumn("reach", reach).withColumn("last", last).withColumn("later", later).where("match is not null")
    first = (F.col("last.start") == F.col("start")) & (F.col("reach") > F.col("start"))
    own = F.when(first, F.col("last")).when(F.col("later.start") < F.col("end"), F.col("later"))
    outside = F.coalesce(F.col("reach") <= F.col("start"), F.lit(True))
    before = F.trim(F.regexp_replace(F.lower("tail"), "[0-9]+", "#"))
    instance = F.coalesce("seed.instance", _instance(F.col("match")))
    return seen.withColumn("seed", own).where(outside | F.col("seed").isNotNull()).select("uid", "start", "end", instance.alias("instance"), before.alias("before"), F.col("seed.kind").alias("kind"))


def _patterns(found: DataFrame) -> DataFrame:
    """A row for each occurrence and each of its patterns."""
    words = F.filter(F.split("before", r"\s+"), lambda w: w != "")
    kept = found.withColumn("w", words)
    each = F.transform(F.sequence(F.lit(1), F.least(F.size("w"), F.lit(CONTEXT))), lambda n: F.array_join(F.slice(F.col("w"), -n, n), " "))
    return kept.where(F.size("w") > 0).withColumn("pattern", F.explode(each)).drop("w", "before")


def bootstrap(found: DataFrame) -> DataFrame:
    """(uid, kind, start, end) of what the patterns discover among occurrences()."""
    rows = settle(_patterns(found))
    links = settle(rows.groupBy("pattern", "instance").agg(F.max("kind").alias("seed")))
    seeds = links.where("seed is not null").select("instance", F.col("seed").alias("kind"), F.lit(1.0).alias("score")).distinct()
    scores, good = seeds, None
    size = links.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    for _ in range(ROUNDS):
        sums = links.join(scores, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("worth"))
        good = sums.join(size, "pattern").withColumn("confidence", F.col("worth") / (F.col("n") + 1)).where((F.col("confidence") >= CONFIDENCE) & (F.col("worth") >= SUPPORT))
        good = settle(good.select("pattern", "kind", "confidence"))
        new = links.join(good, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - 0.9 * F.col("confidence"))))).alias("score"))
        scores = settle(seeds.union(new).groupBy("instance", "kind").agg(F.max("score").alias("score")))
    looks = reduce(lambda a, b: a | b, [(F.col("kind") == i) & F.col("instance").rlike(LOOKS[k]) for i, k in enumerate(KINDS)])
    chosen = rows.where("kind is null").drop("kind").join(good, "pattern").where(looks)
    best = F.max(F.struct("confidence", "kind"))
    return chosen.groupBy("uid", "start", "end").agg(best.alias("b")).select("uid", "b.kind", "start", "end")


def _listed(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _found(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """scan(), and (uid, kind, start, end, added) for each span."""
    scanned = scan(docs, doc_id, text)
    base = settle(base_spans(scanned))
    added = bootstrap(occurrences(scanned, base))
    return scanned, base.drop("instance").withColumn("added", F.lit(False)).unionByName(added.withColumn("added", F.lit(True)))


def discovery_recall(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """(kind, hidden, found, discovered) of a run that doesn't know every `folds`-th identifier, chosen by a hash.

    hidden are the base spans of those identifiers, found those of them that the patterns discover with the same
    kind and ends, and discovered all spans that they discover. A kind without hidden or discovered spans has no row.
    """
    scanned = scan(docs, doc_id, text)
    base = settle(base_spans(scanned).withColumn("hide", F.pmod(F.xxhash64("instance"), F.lit(folds)) == 0))
    added = bootstrap(occurrences(scanned, base.where(~F.col("hide")).drop("hide")))
    hidden = base.where("hide").select("uid", "kind", "start", "end", F.lit(1).alias("h"))
    both = hidden.join(added.withColumn("a", F.lit(1)), ["uid", "kind", "start", "end"], "full")
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return both.groupBy(name.alias("kind")).agg(F.count("h").alias("hidden"), F.count(F.when(F.col("h") == F.col("a"), 1)).alias("found"), F.count("a").alias("discovered"))


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, base, added), a row for each document; base and added are arrays of (kind, start, end)."""
    scanned, both = _found(docs, doc_id, text)
    span = F.struct("kind", "start", "end")
    # a group is the spans of one document
    own = both.groupBy("uid").agg(F.collect_list(F.when(~F.col("added"), span)).alias("base"), F.collect_list(F.when(F.col("added"), span)).alias("more"))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return scanned.select("uid", "doc_id", "key").join(own, "uid", "left").select("doc_id", "key", F.coalesce("base", none).alias("base"), F.coalesce("more", none).alias("added"))


def mask(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with each span of personal data replaced by its kind in angle brackets; null texts stay null.

    Spans that overlap are one, of the kind of the first. Only texts with a digit or an @ can have spans;
    the others are not shuffled. Cutting takes time in proportion to the text and its spans.
    """
    scanned, both = _found(docs, doc_id, text)
    before = Window.partitionBy("uid").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    rows = both.withColumn("reach", F.coalesce(F.max("end").over(before), F.lit(0).cast("long")))
    # a cut: where the one before ended, where it begins, and its kind
    cut = F.when(F.col("start") >= F.col("reach"), F.struct("start", "reach", "kind"))
    own = rows.groupBy("uid").agg(F.struct(F.max("end").alias("last"), F.sort_array(F.collect_list(cut)).alias("cuts")).alias("spans"))
    name, doc, key = free_names(docs, "spans", "doc", "key")
    # equal documents have equal spans: one row of them is enough
    own = scanned.join(own, "uid").groupBy(F.col("doc_id").alias(doc), F.col("key").alias(key)).agg(F.first("spans").alias(name))
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    may = t.rlike("[0-9@]")
    joined = docs.where(may).join(own, F.col(doc_id).cast("long").eqNullSafe(F.col(doc)) & (F.xxhash64(t) == F.col(key)), "left")
    kinds = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def masked(blocks: Column) -> Column:
        def piece(begin: Column, end: Column) -> Column:
            first = F.floor(begin / _BLOCK)
            whole = F.array_join(F.slice(blocks, (first + 1).cast("int"), (F.floor((end - 1) / _BLOCK) - first + 1).cast("int")), "")
            return F.when(end > begin, F.substring(whole, (begin - first * _BLOCK + 1).cast("int"), (end - begin).cast("int"))).otherwise("")

        cuts = F.transform(f"{name}.cuts", lambda c: F.concat(piece(c["reach"], c["start"]), F.element_at(kinds, c["kind"] + 1)))
        return F.concat(F.array_join(cuts, ""), piece(F.col(f"{name}.last"), F.length(t).cast("long")))

    # a lambda's argument is computed once
    done = F.element_at(F.transform(F.array(F.regexp_extract_all(t, F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))), masked), 1)
    shown = joined.withColumn(text, F.when(F.col(name).isNotNull(), done).otherwise(F.col(text))).select(*docs.columns)
    return shown.union(docs.where(~may).withColumn(text, F.col(text).cast("string")))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))
