"""Personal data: generators propose spans, boosted trees decide, calibrated thresholds select.

Four base kinds are found by fixed expressions and their checks. Generators with high recall
propose further, overlapping spans: spelled-out addresses, numbers without a country code,
groups of digits with other separators, longer dotted or colon-separated numbers. What these
propose has no label. Gradient boosted trees learn format and context from base spans that are
rewritten into those formats where they stand (positive), and from what cannot be personal data in the
same formats (negative): the words around a match put together like an address, area codes that no
number has, cards with a wrong check digit, rows of bytes, and matches of the base expressions
that fail their checks (only those that overlap neither a base span nor a proposal). Of each
generator, the threshold is the lowest at which the rewritten ones of a held-out part are precise. What passes and does not overlap a
base span is added under the kind of its generator.

Everything is DataFrame functions. Places of matches come from the lengths of the pieces
between them. Only texts with what some generator requires are looked at closer.

Defined cases: null texts are empty; texts without spans have counts of 0 and empty lists;
repeated rows are rows of their own; without examples of both outcomes nothing is added; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetwane.llm.text import whole
from fleetwane.session import store

KINDS = ("email", "ip", "card", "phone")

#: Base expressions. Possessive quantifiers, and starts only where a run of characters starts or the
#: last match ended, find the same matches without trying each run from every character of it.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators: kind and expression. The first four are the base ones.
PROPOSALS = (
    *((k, BASE[k]) for k in KINDS),
    ("email", r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++(?<!\.)(?:\x20?(?:\(at\)|\[at\]|@)\x20?|\x20at\x20)[a-z0-9-]++(?:(?:\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20|\.)[a-z0-9-]++)++"),
    ("phone", r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[\x20.-]?)?\(?[0-9]{3}\)?[\x20./-]{1,2}[0-9]{3}[\x20./-][0-9]{4}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,2}[0-9]{4}){2}[\x20._/-]{1,2}[0-9]{1,7}(?![0-9])"),
    ("ip", r"(?i)(?<![0-9a-f:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-f:])"),
)

#: Characters of context on each side.
CONTEXT = 24
#: Words around personal data, in lower case.
CUES = {
    "email": "mail|contact|write|address",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|pay",
    "phone": "phone|tel|call|mobile|fax",
}

#: Endings of domains that set an address apart from two sentences without a blank between them (all small or all capital letters).
ENDINGS = "com|org|net|edu|gov|info|io|co|eu|uk|de|fr|es|it|nl|ch|at"

#: Distinct examples that the trees learn from at most (those with the smallest hash), trees, depth and step.
SAMPLE = 20_000
TREES = 12
DEPTH = 4
STEP = 0.3
#: One part in so many of all examples is held out of the sample to set the thresholds.
HELD_OUT = 4
#: Precision that examples of a generator above its threshold must have there, and how many there must be.
PRECISION = 0.99
LEAST_HELD_OUT = 20


def luhn(digits: Column) -> Column:
    """The check digit of a string of digits is right."""
    flat = F.split(F.reverse(digits), "")
    doubled = F.transform(
        flat,
        lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))),
    )
    return F.aggregate(doubled, F.lit(0), lambda total, x: total + F.coalesce(x, F.lit(0))) % 10 == 0


def _passes(gen: Column, hit: Column) -> Column:
    """The checks of the base kinds (``gen`` below 4)."""
    digits = F.regexp_replace(hit, "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    small = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0))).otherwise(999) <= 255))
    return (
        F.when(gen == 0, True)
        .when(gen == 1, small)
        .when(gen == 2, F.when((n >= 14) & (n <= 19), luhn(digits)).otherwise(False))
        .when(gen == 3, (n >= 10) & (n <= 15))
        .otherwise(False)
    )


def _worth_a_look(text: Column) -> Column:
    low = F.lower(text)
    spelled = low.rlike(r"\(at\)|\[at\]|\x20at\x20") & (low.contains(".") | low.contains("dot"))
    return text.rlike("[0-9@]") | spelled | low.rlike("(?:[a-f]{1,4}:){7}[a-f]")


def _hits(docs: DataFrame) -> DataFrame:
    """uid, doc_id, gen, start, end, hit and context of every match; texts without any keep one row with null gen."""
    cut = [
        F.struct(F.lit(i).alias("gen"), F.split("text", pattern, -1).alias("pieces"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("hits"))
        for i, (_, pattern) in enumerate(PROPOSALS)
    ]
    each = docs.select("uid", "doc_id", F.explode(F.array(*cut)).alias("g")).select("uid", "doc_id", "g.*")
    each = each.filter((F.size("hits") > 0) | (F.col("gen") == 0))
    nexts = F.slice("pieces", F.lit(2), F.size("pieces"))
    rows = each.select(
        "uid", "doc_id", "gen", F.posexplode_outer(F.when(F.size("hits") > 0, F.arrays_zip("pieces", "hits", nexts.alias("nexts")))).alias("nth", "m")
    )
    # the last piece has no hit
    rows = rows.filter(F.col("m.hits").isNotNull() | F.col("m").isNull())
    before = F.sum(F.length("m.pieces") + F.length("m.hits")).over(Window.partitionBy("uid", "gen").orderBy("nth"))
    return rows.select(
        "uid",
        "doc_id",
        F.when(F.col("m").isNotNull(), F.col("gen")).alias("gen"),
        (before - F.length("m.hits")).cast("long").alias("start"),
        before.cast("long").alias("end"),
        F.col("m.hits").alias("hit"),
        F.right("m.pieces", F.lit(CONTEXT)).alias("left"),
        F.left("m.nexts", F.lit(CONTEXT)).alias("right"),
    )


def _features(rows: DataFrame) -> DataFrame:
    """Format and context of a proposal, as numbers."""
    hit, around = F.col("hit"), F.lower(F.concat_ws(" ", "left", "right"))
    digits = F.regexp_replace(hit, "[^0-9]", "")
    kind = F.element_at(F.array(*(F.lit(KINDS.index(k)) for k, _ in PROPOSALS)), F.col("gen") + 1)
    # how many digits or letters an address has says nothing about it
    number = kind != KINDS.index("email")
    cues = [F.when((kind == KINDS.index(k)) & around.rlike(rf"\b(?:{words})"), 1).otherwise(0) for k, words in CUES.items()]
    features = {
        "kind": kind,
        "gen": F.col("gen"),
        "length": F.when(number, F.length(hit)).otherwise(0),
        "digits": F.when(number, F.length(digits)).otherwise(0),
        "letters": F.when(number, F.length(F.regexp_replace(hit, "[^A-Za-z]", ""))).otherwise(0),
        "spaces": F.length(F.regexp_replace(hit, "[^ ]", "")),
        "dots": F.length(F.regexp_replace(hit, r"[^.]", "")),
        "dashes": F.length(F.regexp_replace(hit, "[^-/_:]", "")),
        "at": F.when(hit.contains("@"), 1).otherwise(0),
        "plus": F.when(hit.startswith("+"), 1).otherwise(0),
        "check": F.when(number & (F.length(digits) >= 12) & (F.length(digits) <= 19), F.when(luhn(digits), 2).otherwise(1)).otherwise(0),
        "first": F.when(number, F.coalesce(F.substring(digits, 1, 1).try_cast("int"), F.lit(-1))).otherwise(-1),
        "ending": F.length(F.regexp_extract(hit, "([A-Za-z]*)$", 1)),
        "known_ending": F.when(hit.rlike(rf"(?:\.|(?i:dot)[)\]]?\x20?)(?:{ENDINGS}|{ENDINGS.upper()})$"), 1).otherwise(0),
        "brackets": F.when(hit.rlike(r"[(\[]"), 1).otherwise(0),
        "joined_left": F.when(F.col("left").rlike("[A-Za-z0-9]$"), 1).otherwise(0),
        "joined_right": F.when(F.col("right").rlike("^[A-Za-z0-9]"), 1).otherwise(0),
        "cue": sum(cues),
    }
    named = rows.withColumns({f"f_{k}": v.cast("double") for k, v in features.items()})
    return VectorAssembler(inputCols=[f"f_{k}" for k in features], outputCol="features").transform(named)


def proposals(docs: DataFrame) -> DataFrame:
    """The stored table of matches: uid, doc_id, kind, gen, start, end, hit, context, base (a base span), positive (equals one), alone (overlaps no base span or extra proposal)."""
    numbered = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", whole("text").alias("text"))
    rows = _hits(numbered.filter(_worth_a_look(F.col("text"))))
    kinds = F.array(*(F.lit(KINDS.index(k)) for k, _ in PROPOSALS))
    rows = rows.withColumn("kind", F.element_at(kinds, F.col("gen") + 1))
    rows = rows.withColumn("base", F.coalesce(F.when(F.col("gen") < len(KINDS), _passes(F.col("gen"), F.col("hit"))), F.lit(False)))
    same = Window.partitionBy("uid", "kind", "start", "end")
    rows = rows.withColumn("positive", F.max("base").over(same))
    taken = F.col("base") | (F.col("gen") >= len(KINDS))
    by_start = Window.partitionBy("uid").orderBy("start")
    reached = F.max(F.when(taken, F.col("end"))).over(by_start.rangeBetween(Window.unboundedPreceding, 0))
    following = F.min(F.when(taken, F.col("start"))).over(by_start.rangeBetween(0, Window.unboundedFollowing))
    alone = ~taken & (F.coalesce(reached, F.lit(0)) <= F.col("start")) & F.coalesce(following >= F.col("end"), F.lit(True))
    return store(rows.withColumn("alone", alone), "proposals")


def _examples(rows: DataFrame) -> DataFrame:
    """Labelled proposals: hit, left, right, gen, label, order (a hash), rewritten."""
    rows = rows.filter((F.col("gen") < len(KINDS)) & (F.col("base") | F.col("alone")))
    order, hit = F.xxhash64("hit", "left", "right", "gen"), F.col("hit")
    digits = F.regexp_replace(hit, "[^0-9]", "")

    def one_of(*choices: str) -> Column:
        return F.element_at(F.array(*map(F.lit, choices)), (F.pmod(order, F.lit(len(choices))) + 1).cast("int"))

    def grouped(text: Column, size: int, between: Column) -> Column:
        return F.regexp_replace(text, F.lit("(.{%d})(?=.)" % size), F.concat(F.lit("$1"), between))

    def local(number: Column) -> Column:
        parts = [F.substring(number, 1, 3), F.substring(number, 4, 3), F.substring(number, 7, 4)]
        opens, closes, between = one_of("(", "", "", ""), one_of(") ", "-", ".", "/"), one_of("-", "-", ".", "-")
        return F.concat(opens, parts[0], closes, parts[1], between, parts[2])

    at, dot, between = one_of(" (at) ", "(at)", " at ", "[at]", " [at] "), one_of(".", " (dot) ", ".", "[dot]", " dot "), one_of(".", "/", "_", " - ")
    between = F.when(between == " - ", F.lit("- ")).otherwise(between)

    def example(gen: int, text: Column, when: Column, label: int) -> Column:
        return F.when(when, F.struct(text.alias("hit"), F.lit(gen).alias("gen"), F.lit(float(label)).alias("label"), F.lit(True).alias("rewritten")))

    base, gen, n = F.col("base"), F.col("gen"), F.length(digits)
    ten = F.right(digits, F.lit(10))
    no_area = F.concat(one_of("0", "1"), F.right(digits, F.lit(9)))
    wrong_check = F.concat(F.left(digits, n - 1), ((F.right(digits, F.lit(1)).try_cast("int") + 1) % 10).cast("string"))
    parts = [F.lower(F.lpad(F.hex(F.get(F.split(hit, r"\."), F.lit(i)).try_cast("long")), 2, "0")) for i in range(4)]
    as_v6 = F.concat(one_of("0:0:0:0:0:ffff:", "2002:"), parts[0], parts[1], F.lit(":"), parts[2], parts[3], one_of("", ":0:0:0:0:1"))
    last, following = F.regexp_extract("left", "([A-Za-z]+)[^A-Za-z]*$", 1), r"([A-Za-z]+)[^A-Za-z]+([A-Za-z]+)"
    next_word, after = F.regexp_extract("right", following, 1), F.regexp_extract("right", following, 2)
    # digits, or none, tell nothing about an address
    coin = F.pmod(F.xxhash64(order), F.lit(2)) == 0
    after = F.when(F.pmod(order, F.lit(2)) == 0, F.initcap(after)).otherwise(after)
    prose = F.concat(last, F.when(coin, F.right(order.cast("string"), F.lit(2))).otherwise(""), F.lit(" at "), next_word, F.lit("."), after)
    is_prose = (last != "") & (after != "") & ~after.rlike(f"^(?:{ENDINGS}|{ENDINGS.upper()})$")
    local_part = F.substring_index(hit, "@", 1)
    bare = F.regexp_replace(local_part, "[0-9]", "")
    local_part = F.when(coin & bare.rlike("[A-Za-z]$"), bare).otherwise(local_part)
    spelled = F.concat(local_part, at, F.replace(F.substring_index(hit, "@", -1), F.lit("."), dot))
    made = F.array(
        F.struct(hit.alias("hit"), gen.alias("gen"), F.when(base, 1.0).otherwise(0.0).alias("label"), F.lit(False).alias("rewritten")),
        example(4, spelled, base & (gen == 0), 1),
        example(5, local(ten), base & (gen == 3) & ten.rlike("^[2-9][0-9]{2}[2-9]"), 1),
        example(6, grouped(digits, 4, between), base & (gen == 2), 1),
        example(7, as_v6, base & (gen == 1), 1),
        example(4, prose, is_prose, 0),
        example(5, local(no_area), (n >= 10) & ((base & (gen == 3)) | ~base), 0),
        example(6, grouped(wrong_check, 4, between), base & (gen == 2), 0),
        example(6, grouped(F.left(digits, F.lit(19)), 4, between), ~base & (n >= 14) & ~luhn(F.left(digits, F.lit(19))), 0),
        example(7, grouped(F.rpad(digits, 16, digits), 2, F.lit(":")), (n >= 4) & (~base | (gen == 1)), 0),
    )
    each = rows.select("left", "right", order.alias("order"), F.explode(F.filter(made, lambda x: x.isNotNull())).alias("e"))
    return each.select("e.*", "left", "right", "order")


def _thresholds(scored: DataFrame) -> dict[int, float]:
    """By generator, the lowest probability from which on the held-out examples are precise; a hundred steps."""
    step = F.floor(F.col("probability_1") * 100)
    steps = scored.groupBy(F.col("f_gen").cast("int").alias("gen"), step.alias("step")).agg(F.count("*").alias("n"), F.sum("label").alias("right")).collect()
    best, seen = {}, {}
    for r in sorted(steps, key=lambda r: -r["step"]):
        n, right = seen.get(r["gen"], (0, 0))
        n, right = seen[r["gen"]] = n + r["n"], right + r["right"]
        if n >= LEAST_HELD_OUT and right >= PRECISION * n:
            best[r["gen"]] = r["step"] / 100
    return best


def _added(rows: DataFrame) -> DataFrame | None:
    """uid, start, kind, end of proposals that the trees select beyond the base spans."""
    examples = _examples(rows.filter(F.col("gen").isNotNull()))
    fold = F.pmod(F.xxhash64("order", F.lit("fold")), F.lit(HELD_OUT))  # apart from the choices of formats
    once = examples.filter(fold != 0).dropDuplicates(["hit", "left", "right", "gen"])
    learn = store(_features(once.orderBy("order", "gen").limit(SAMPLE)).select("features", "label"), "sample")
    if {r["label"] for r in learn.select("label").distinct().collect()} != {0.0, 1.0}:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1, maxBins=32).fit(learn)
    probability = vector_to_array("probability")[1].alias("probability_1")
    held_out = _features(examples.filter((fold == 0) & F.col("rewritten")))
    thresholds = _thresholds(model.transform(held_out).select("f_gen", "label", probability))
    if not thresholds:
        return None
    scored = model.transform(_features(rows.filter((F.col("gen") >= len(KINDS)) & ~F.col("positive")))).select("uid", "start", "kind", "gen", "end", probability)
    least = F.element_at(F.array(*(F.lit(thresholds.get(g, 2.0)) for g in range(len(PROPOSALS)))), F.col("gen") + 1)
    return scored.filter(F.col("probability_1") >= least).select("uid", "start", "kind", "end")


def _span_rows(docs: DataFrame) -> DataFrame:
    """uid, doc_id, base, added (sorted arrays of start, kind, end) of texts with something to look at."""
    rows = proposals(docs)
    span = F.struct("start", "kind", "end")
    base = rows.groupBy("uid", "doc_id").agg(F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"))
    extra = _added(rows)
    if extra is None:
        return base.withColumn("added", F.slice("base", F.lit(1), F.lit(0)))
    extra = extra.groupBy("uid").agg(F.sort_array(F.collect_set(span)).alias("more"))
    both = base.join(extra, "uid", "left")
    apart = F.filter(
        F.coalesce("more", F.slice("base", F.lit(1), F.lit(0))),
        lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])),
    )
    return both.select("uid", "doc_id", "base", apart.alias("added"))


def _written(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(each, ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans and n_added of every whole text."""
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(len(KINDS))]
    digest = F.sha2(_written(F.col("base")), 256).alias("base_sha256")
    spans = _written(F.sort_array(F.concat("base", "added"))).alias("spans")
    looked_at = _span_rows(docs).select("doc_id", *counts, digest, spans, F.size("added").cast("long").alias("n_added"))
    zeros = [F.lit(0).cast("long").alias(f"n_{k}") for k in (*KINDS, "added")]
    rest = docs.filter(~_worth_a_look(whole("text"))).select("doc_id", *zeros[:4], F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"), zeros[4])
    return looked_at.union(rest)
