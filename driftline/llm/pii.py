"""Personal data by weak supervision, with DataFrame functions only.

Candidate spans are what loose patterns find. Labelers look at each: strict
patterns and checksums, gazetteers (top-level domains, card prefixes, calling
codes) and the words before it; each votes for, against, or not at all.
Expectation-maximisation over the counts of vote patterns estimates how often
each labeler is right for each kind, without labels. The posteriors then train
a span classifier (logistic regression over votes and the shape of the span),
which decides on the candidates beyond the base patterns. Base spans always stay.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_chunks, materialize, text_or_empty

#: The base patterns. A start is where the pattern could first match (the run of its first class
#: begins, or the last match ended), and quantifiers are possessive where giving back can't help, so
#: long runs take linear time and no stack. A card's run of digits has 13 to 19 of them in all.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(BASE)
#: What a text must contain for a pattern to be worth running.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}

#: Loose patterns, whose matches beyond the base spans are candidates.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?:\s?[\[(](?:at|AT)[\])]\s?)[A-Za-z0-9-]{1,63}+"
             r"(?:(?:\.|\s?[\[(](?:dot|DOT)[\])]\s?)[A-Za-z0-9-]{1,63}+)++",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Za-z:])",
    "card": r"(?<![0-9A-Za-z.,+-])[0-9]{4}+([\x20-])[0-9]{4}+\1[0-9]{4}+\1[0-9]{4}+(?![0-9A-Za-z-])",
    "phone": r"(?<![0-9A-Za-z+)-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.\x20])[0-9]{3}[-.\x20][0-9]{4}(?![0-9A-Za-z-])",
}
LOOSE_NEEDS = {"email": r"[\[(](?:at|AT)[\])]", "ip": r"(?:[0-9A-Fa-f]{1,4}:){7}",
               "card": r"[0-9]{4}[\x20-][0-9]{4}[\x20-]", "phone": r"[0-9]{3}[-.)\x20]{1,2}[0-9]{3}[-.\x20][0-9]{4}"}

#: Gazetteers.
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "co", "info", "de", "fr", "es", "uk", "it", "nl", "eu", "us", "ca")
CALLING_CODES = r"^\+(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?[2-9][0-9]{2}"
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write", "correo", "courriel", "kontakt"),
    "ip": ("ip", "address", "host", "server", "login", "from", "client"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "amex", "payment", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "cell", "tel.", "telefon", "téléphone", "teléfono"),
}
#: Words that say a number is something else.
AGAINST = ("order", "isbn", "id", "no", "number", "version", "section", "article", "page", "figure", "table", "chapter",
           "row", "item", "sku", "serial")
LABELERS = ("pattern", "checksum", "gazetteer", "context", "shape", "surroundings")
ROUNDS = 30
#: Probability from which the classifier adds a candidate.
LEAST = 0.9
#: Code points in one block of a text in which the surroundings of spans are looked up.
BLOCK = 1024
SPANS = "array<struct<start:int,end:int,match:string>>"


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    return F.aggregate(F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(
        i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int"))),
        F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """What a base match must satisfy besides its pattern."""
    if kind == "ip":
        parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(999)) <= 255))
    if kind == "card":
        return luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    return F.lit(True)


def once(x: Column, use) -> Column:
    """``use(x)`` with ``x`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(x), use), 1)


def matches(text: Column, pattern: str, needs: str) -> Column:
    """Spans (start, end, match) of a pattern's matches, leftmost and non-overlapping, in code points.

    The texts between the matches give the places: a prefix sum over both, in time linear in the matches.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    none = F.expr(f"cast(array() as {SPANS})")
    pairs = F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))

    def placed(chunk: Column, at: Column) -> Column:
        return F.aggregate(
            chunk, F.struct(at.alias("at"), none.alias("out")),
            lambda a, x: F.struct(
                (a["at"] + x["g"] + F.length(x["m"])).alias("at"),
                F.concat(a["out"], F.array(F.struct(
                    (a["at"] + x["g"]).alias("start"), (a["at"] + x["g"] + F.length(x["m"])).alias("end"),
                    x["m"].alias("match")))).alias("out")))["out"]

    # Appending copies the array, so sums of chunks first give each chunk its own start.
    def spans(some: Column) -> Column:
        sums = F.transform(some, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + x["g"] + F.length(x["m"])))
        starts = F.aggregate(sums, F.array(F.lit(0)), lambda a, n: F.concat(a, F.array(F.element_at(a, -1) + n)))
        return F.flatten(F.zip_with(some, F.slice(starts, F.lit(1), F.size(some)), placed))

    def chunked(some: Column) -> Column:
        return once(in_chunks(some), spans)

    return F.when(text.rlike(needs), once(pairs, chunked)).otherwise(none)


def vote(good: Column | None = None, bad: Column | None = None) -> Column:
    """1 if ``good``, else -1 if ``bad``, else 0."""
    out = F.lit(0)
    if bad is not None:
        out = F.when(bad, -1).otherwise(out)
    if good is not None:
        out = F.when(good, 1).otherwise(out)
    return out.cast("int")


def in_blocks(text: Column) -> Column:
    """A text as its blocks of BLOCK code points (the last may be shorter)."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part(blocks: Column, start: Column, size: Column) -> Column:
    """``size`` (BLOCK at most) code points of a text in blocks from ``start`` on. A substring of the
    whole text would walk to it from the text's beginning."""
    block = F.floor(start / BLOCK).cast("int")
    near = F.concat(*[F.coalesce(F.get(blocks, block + i), F.lit("")) for i in (0, 1)])
    return F.substring(near, start - block * BLOCK + 1, size)


def words_before(blocks: Column, start: Column) -> Column:
    """The lower-case words in the 40 characters before a place."""
    size = F.least(start, F.lit(40))
    return F.split(F.lower(F.btrim(part(blocks, start - size, size))), r"[^\p{L}\p{N}.-]+")


def votes(kind: str, blocks: Column, span: Column, strict: Column) -> list[Column]:
    """The votes of LABELERS on a span."""
    match, number = span["match"], digits(span["match"])
    domain = F.element_at(F.split(F.lower(match), r"[.@]|\bdot\b|[\[\]()\s]+"), -1)
    checksum = {
        "email": vote(domain.rlike("^[a-z]{2,24}$"), ~domain.rlike("^[a-z]{2,24}$")),
        "ip": vote(strict, match.rlike(r"^[0-9.]+$") & ~strict),
        "card": vote(luhn(number), ~luhn(number)),
        "phone": vote(F.length(number).between(10, 13), ~F.length(number).between(9, 15))}[kind]
    gazetteer = {
        "email": vote(domain.isin(*DOMAINS)),
        "ip": vote(match.rlike(r"^0*(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\."), match.rlike(r"^0+\.")),
        "card": vote(number.rlike(CARD_PREFIX), ~number.rlike(CARD_PREFIX)),
        "phone": vote(match.rlike(CALLING_CODES), match.rlike(r"^\(?[01]{3}"))}[kind]
    before = words_before(blocks, span["start"])
    context = vote(F.arrays_overlap(before, F.array(*map(F.lit, CONTEXT[kind]))),
                   F.arrays_overlap(before, F.array(*map(F.lit, AGAINST))))
    shape = {
        "email": vote(match.rlike("^[^@]*[A-Za-z]")),
        "ip": vote(~match.rlike(r"(?:^|\.)0[0-9]"), match.rlike(r"(?:^|\.)0[0-9]")),
        "card": vote((F.length(number) == 16) | match.rlike(r"^[0-9]{4}[\x20-]")),
        "phone": vote(match.rlike(r"[0-9][).\x20-]+[0-9]"))}[kind]
    around = F.concat(part(blocks, F.greatest(span["start"] - 1, F.lit(0)), F.when(span["start"] > 0, 1).otherwise(0)),
                      F.lit("_"), part(blocks, span["end"], F.lit(1)))
    surroundings = vote(~around.rlike(r"[\p{L}\p{N}]"), around.rlike(r"[\p{L}\p{N}]"))
    return [vote(strict), checksum, gazetteer, context, shape, surroundings]


def labelled_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``__id``, for each kind its base spans, and all candidates with their votes."""
    text = F.col("__text")
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text"))
    raw = rows.select("*", *[matches(text, BASE[k], NEEDS[k]).alias(f"__{k}") for k in KINDS],
                      *[matches(text, LOOSE[k], LOOSE_NEEDS[k]).alias(f"__{k}_loose") for k in KINDS])

    def base(kind: str) -> Column:
        return F.filter(F.col(f"__{kind}"), lambda s: valid(kind, s["match"]))

    some = F.size(F.concat(*[F.col(f"__{k}{x}") for k in KINDS for x in ("", "_loose")])) > 0
    loose = F.size(F.concat(*[F.col(f"__{k}_loose") for k in KINDS])) > 0
    raw = raw.select(
        "*", F.when(some, in_blocks(text)).alias("__blocks"),
        F.when(loose, F.transform(in_chunks(F.array_sort(F.concat(*map(base, KINDS)))), lambda c: F.struct(
            F.array_min(F.transform(c, lambda t: t["start"])).alias("start"),
            F.array_max(F.transform(c, lambda t: t["end"])).alias("end"), c.alias("spans")))).alias("__taken"))

    def candidates(kind: str, spans: Column, strict) -> Column:
        return F.transform(spans, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), strict(s).alias("base"),
            *[v.cast("int").alias(n) for n, v in zip(LABELERS, votes(kind, F.col("__blocks"), s, strict(s)))],
            F.least(F.lit(4), F.floor((s["end"] - s["start"]) / 8)).cast("int").alias("size")))

    def beyond(spans: Column) -> Column:
        """Loose matches that touch no base span of any kind; the chunks of base spans are tested first."""
        def touches(t: Column, s: Column) -> Column:
            return (t["start"] < s["end"]) & (s["start"] < t["end"])

        return F.filter(spans, lambda s: ~F.exists("__taken", lambda c: F.when(
            touches(c, s), F.exists(c["spans"], lambda t: touches(t, s))).otherwise(False)))

    found = F.concat(*[candidates(k, F.col(f"__{k}"), lambda s, k=k: valid(k, s["match"])) for k in KINDS],
                     *[candidates(k, beyond(F.col(f"__{k}_loose")), lambda s: F.lit(False)) for k in KINDS])
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,base:boolean," +
                  ",".join(f"{n}:int" for n in LABELERS) + ",size:int>>)")
    return raw.select("__id", F.when(some, found).otherwise(none).alias("candidates"))


def reliabilities(counts: list[tuple[str, tuple[int, ...], int]]) -> tuple[dict, dict]:
    """Expectation-maximisation over vote patterns: (kind, votes, number of spans).

    Returns the log-odds of each kind, and for each (kind, labeler, vote) the log
    of how much likelier the vote is on personal data. Starts from the sum of votes.
    """
    right = {(k, v): 1 / (1 + math.exp(-sum(v))) for k, v, _ in counts}
    prior: dict = {}
    weight: dict = {}
    for _ in range(ROUNDS):
        total: dict = {}
        seen: dict = {}
        for kind, v, n in counts:
            for y, share in ((1, right[kind, v]), (0, 1 - right[kind, v])):
                total[kind, y] = total.get((kind, y), 1.0) + n * share
                for i, x in enumerate(v):
                    seen[kind, i, x, y] = seen.get((kind, i, x, y), 0.0) + n * share
        kinds = {k for k, _, _ in counts}
        prior = {k: math.log(total[k, 1] / total[k, 0]) for k in kinds}
        weight = {(k, i, x): math.log((seen.get((k, i, x, 1), 0.0) + 1) / (total[k, 1] + 3)) -
                  math.log((seen.get((k, i, x, 0), 0.0) + 1) / (total[k, 0] + 3))
                  for k in kinds for i in range(len(LABELERS)) for x in (-1, 0, 1)}
        right = {(k, v): 1 / (1 + math.exp(-max(-30.0, min(30.0, prior[k] + sum(
            weight[k, i, x] for i, x in enumerate(v)))))) for k, v, _ in counts}
    return prior, weight


def features(row: dict[str, Column]) -> list[Column]:
    """Inputs of the span classifier: the kind, each vote, the size."""
    return [*[(row["kind"] == k).cast("double") for k in KINDS],
            *[(row[n] == x).cast("double") for n in LABELERS for x in (-1, 1)],
            *[(row["size"] == x).cast("double") for x in range(4)]]


def train(patterns: DataFrame) -> tuple[list[float], float] | None:
    """Weights and intercept of the span classifier, from patterns (kind, votes, size, n)."""
    kinds = patterns.groupBy("kind", *LABELERS).agg(F.sum("n").alias("n"))
    counts = [(r.kind, tuple(r[n] for n in LABELERS), r.n) for r in kinds.collect()]  # 4 * 3^6 rows at most
    if not counts:
        return None
    prior, weight = reliabilities(counts)
    odds = F.create_map(*[F.lit(x) for k in prior for x in (k, prior[k])])[F.col("kind")]
    for i, name in enumerate(LABELERS):
        table = F.create_map(*[F.lit(x) for (k, j, v), w in weight.items() if j == i for x in (f"{k}{v}", w)])
        odds = odds + table[F.concat("kind", F.col(name).cast("string"))]
    right = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), odds))))
    inputs = patterns.select("n", right.alias("right"), array_to_vector(F.array(
        *features({c: F.col(c) for c in patterns.columns}))).alias("features"))
    rows = inputs.select("features", F.lit(1.0).alias("label"), (F.col("n") * F.col("right")).alias("weight")).unionAll(
        inputs.select("features", F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("right"))).alias("weight")))
    model = LogisticRegression(weightCol="weight", regParam=1e-3, maxIter=25).fit(rows.where("weight > 0").coalesce(1))
    return [float(x) for x in model.coefficients], float(model.intercept)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """One row per input row: ``id_col`` and arrays base and spans of (kind, start, end).

    Places are code points of the text, ends exclusive; both arrays are ordered
    by kind as in KINDS, then start. ``spans`` holds the base spans and those
    candidates that the classifier gives at least ``least``. Null texts are empty
    and have none; rows that repeat are judged alike; an empty table gives an
    empty result; other columns are ignored. The classifier is trained on the
    candidates of all rows, whose vote patterns (a fixed number) are counted.
    """
    found = materialize(labelled_spans(docs, id_col, text_col), "pii-spans")
    patterns = found.select(F.explode("candidates").alias("c")).select("c.*") \
        .groupBy("kind", *LABELERS, "size").agg(F.count(F.lit(1)).alias("n"))
    model = train(materialize(patterns.coalesce(1), "pii-patterns"))

    def good(c: Column) -> Column:
        if model is None:
            return c["base"]
        inputs = features({n: c[n] for n in ("kind", *LABELERS, "size")})
        score = F.lit(model[1])
        for w, x in zip(model[0], inputs):
            score = score + F.lit(w) * x
        return c["base"] | (score >= math.log(least / (1 - least)))

    def of_kind(kind: str, keep) -> Column:
        return F.array_sort(F.transform(
            F.filter("candidates", lambda c: (c["kind"] == kind) & keep(c)),
            lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))

    def ordered(keep) -> Column:
        return F.concat(*[of_kind(k, keep) for k in KINDS])

    return found.select(F.col("__id").alias(id_col), ordered(lambda c: c["base"]).alias("base"),
                        ordered(good).alias("spans"))


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
