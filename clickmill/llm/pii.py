"""Personal data in texts: base rules, and boosted trees over generously generated candidates.

Base spans come from strict patterns with validators (email, ip, card, phone) and always stay. Besides, high-recall generators
propose spans, which may overlap each other and the base: loose and spelled-out addresses, digit groups, single runs and
phone shapes inside longer groups, dotted numbers with spaces or brackets, and opaque tokens. Gradient-boosted trees score each
candidate by the form of its text and by the characters around it; calibrated thresholds select from those that do not
touch a base span. Selected spans may overlap each other; ``redact`` covers overlapping ones as one.

There is no table of labelled personal data, so the labels are made from the texts. What a base rule accepts is
rewritten in ways that it would miss, in its own surroundings (missed data are taken to look like found data): a phone number without its plus sign or country code or with dots, an
address with "at" and "dot", dots in brackets, a card number next to other digits. A token assigned to a name such as
token, key or password counts as it stands and once more without the name. These variants are the positives. The other
candidates that touch no base span are unlabelled, and some of them are personal data. So a first fit ranks them, and those
that it scores like held-out variants (the lowest twentieth aside, and never under ``FLOOR``) are left out as unclear; the
rest are the negatives of the second fit, which decides. A quarter of the candidates, by a hash of the span and of what
stands before, so that copies stay together, is kept out of both fits. The threshold of each generator is the
lowest at which ``PRECISION`` of these held-out candidates are positive; a generator with fewer than ``HELD`` positives among
them is fitted and calibrated on all its candidates.

The texts are scanned once: spans and candidates are written without the texts, and fits, calibration and selection read that
table. Only the fits are bounded: of each generator and label they take the candidates of least hash, ``TRAIN_CANDIDATES``
in all, so a kind that is rare in a large table is fitted as in a small one. The calibration counts all candidates.

Defined cases: a null text is empty and has no spans; an empty table gives an empty result; repeated rows are treated one by
one; without candidates of both labels nothing is added; other columns pass through (a column called ``base``,
``__candidates`` or ``added`` is replaced). Positions are code points, the end exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import materialize, text_of

KINDS = ["email", "ip", "card", "phone", "secret"]
BASE_KINDS = KINDS[:4]

# The patterns match what the plain ones do. Possessive quantifiers and look-behinds keep them linear on long runs; \G lets
# a match begin inside a run that the match before has cut.
BASE_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Plain test that a text can match at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}

#: Between the parts of a spelled-out address.
AT = r"(?:\x20?[\[({]\x20?(?:at|@)\x20?[\])}]\x20?)"
DOT = r"(?:\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?|\x20dot\x20)"
HOST = r"[A-Za-z0-9-]{1,63}+"

GENERATORS = {
    "address": r"(?<![^\s<>()\[\]{}\",;:])[^\s@<>()\[\]{}\",;:]++@[^\s@<>()\[\]{}\",;:]++",
    "spelled": (r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+"
                rf"(?:{AT}{HOST}(?:(?:{DOT}|\.){HOST})++|(?:\x20at\x20|@){HOST}(?:{DOT}{HOST})++)"),
    "digits": r"(?:(?<![A-Za-z0-9])|\G)\+?+\(?+[0-9](?:[\x20().:/-]{0,3}+[0-9]){6,}+",
    "run": r"(?<![A-Za-z0-9])[0-9]{13,19}+(?![A-Za-z0-9])",
    "grouped": r"(?<![A-Za-z0-9])\+?(?:[0-9]{1,3}[\x20.-])?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}[\x20.-][0-9]{3,4}(?![A-Za-z0-9])",
    "dotted": r"(?<![0-9.])[0-9]++(?:\x20?+[\[(]?+(?:\.|dot)[\])]?+\x20?+[0-9]++){2,}+",
    "opaque": r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z+/=_-]*+[0-9])[A-Za-z0-9+/=_-]{16,}+",
}
#: Plain test that a text can hold a spelled-out address.
SPELLED = r"(?i)\bdot\b|[\[({]\x20?(?:at|@|\.)"
ASSIGNED = r"(?i)(?:token|key|secret|password|passwd|auth|credential)[\"']?\s*[=:]\s*[\"']?$"
AROUND = 24

TRAIN_CANDIDATES = 20_000
TREES, DEPTH = 12, 3
PRECISION = 0.98
#: One candidate in so many is held out from the fits; positives that a generator needs among them.
FOLDS, HELD = 4, 20
#: Share of the held-out variants that may score below what counts as unclear, and its least score.
SPIES, FLOOR = 0.05, 0.2
#: Matches per block of the prefix sums.
RUN = 64


def find_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, end, s).

    Starts are sums of the lengths of what stands before. They are summed by blocks, so that a text with very many matches
    takes about linear time.
    """
    spans = "array<struct<start:int,end:int,s:string>>"

    def located(both: Column) -> Column:
        gaps, hits = both["gaps"], both["hits"]
        blocks = F.sequence(F.lit(0), F.size(hits) - 1, F.lit(RUN))

        def length(i: Column) -> Column:
            return F.length(F.get(gaps, i)) + F.length(F.get(hits, i))

        def block(low: Column) -> Column:
            rows = F.sequence(low, F.least(low + RUN, F.size(hits)) - 1)
            zero = F.struct(F.lit(0).alias("at"), F.array().cast(spans).alias("out"))

            def add(acc: Column, i: Column) -> Column:
                start = acc["at"] + F.length(F.get(gaps, i))
                span = F.struct(start.alias("start"), (start + F.length(F.get(hits, i))).alias("end"), F.get(hits, i).alias("s"))
                return F.struct((acc["at"] + length(i)).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

            return F.aggregate(rows, zero, add)

        def join(acc: Column, b: Column) -> Column:
            return F.struct((acc["at"] + b["at"]).alias("at"), F.concat(acc["all"], F.array(F.struct(
                acc["at"].alias("base"), b["out"].alias("out")))).alias("all"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<base:int,out:{spans}>>").alias("all"))
        joined = F.aggregate(F.transform(blocks, block), start, join, lambda acc: acc["all"])
        return F.flatten(F.transform(joined, lambda b: F.transform(b["out"], lambda x: F.struct(
            (x["start"] + b["base"]).alias("start"), (x["end"] + b["base"]).alias("end"), x["s"].alias("s")))))

    both = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("hits"))
    return F.when(text.rlike(pattern), F.get(F.transform(F.array(both), located), 0)).otherwise(F.array().cast(spans))


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    def part(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    total = F.aggregate(F.transform(F.split(F.reverse(digits_of(s)), ""), part), F.lit(0), lambda a, d: a + d)
    return total % 10 == 0


def small_parts(s: Column) -> Column:
    def small(p: Column) -> Column:
        number = F.regexp_replace(p, "^0+(?=.)", "")
        return F.when(F.length(number) <= 3, number.cast("int") <= 255).otherwise(False)

    return F.forall(F.split(s, r"\."), small)


def valid(kind: str, s: Column) -> Column:
    n = F.length(digits_of(s))
    return {"email": F.lit(True), "ip": small_parts(s), "card": F.when(n.between(13, 19), luhn(s)).otherwise(False),
            "phone": n.between(9, 15)}[kind]


def base_spans(text: Column) -> Column:
    """Struct of the valid spans per base kind."""
    def spans(kind: str) -> Column:
        found = F.filter(find_spans(text, BASE_PATTERNS[kind]), lambda x: valid(kind, x["s"]))
        empty = F.array().cast("array<struct<start:int,end:int,s:string>>")
        return F.when(F.contains(text, F.lit(NEEDS[kind])), found).otherwise(empty)

    return F.struct(*[spans(kind).alias(kind) for kind in BASE_KINDS])


def _share(s: Column, other: str) -> Column:
    """Share of the characters that are not in the class ``other``."""
    return (F.length(F.regexp_replace(s, other, "")) / F.length(s)).cast("double")


def features(s: Column, before: Column, after: Column, generator: Column) -> dict[str, Column]:
    """Form of the span and its surroundings, as doubles; digits in a written address say nothing about it."""
    flag = lambda c: F.when(c, 1.0).otherwise(0.0)
    number = lambda c: F.when(generator.isin("address", "spelled"), 0.0).otherwise(c.cast("double"))
    plain = F.regexp_replace(s, r"(?i)\x20?[\[(]?(?:\.|dot)[\])]?\x20?", ".")
    named = r"(?i)(?:mail|contact|phone|tel|call|fax|mobile|card|visa|ip|host|addr|token|key|secret|passw|auth)[a-z]*[\"']?\W{0,4}$"
    return {
        **{f"is_{g}": flag(generator == g) for g in GENERATORS}, "length": F.length(s).cast("double"),
        "n_digits": number(F.length(digits_of(s))), "digit_share": number(_share(s, "[^0-9]")),
        "hex_share": _share(s, "[^0-9a-f]"), "upper_share": _share(s, "[^A-Z]"),
        "n_dots": F.length(F.regexp_replace(s, r"[^.]", "")).cast("double"),
        "n_slashes": F.length(F.regexp_replace(s, r"[^:/]", "")).cast("double"),
        "n_gaps": F.length(F.regexp_replace(s, r"[^\x20().:/-]", "")).cast("double"),
        "n_groups": number(F.size(F.array_remove(F.split(s, r"[^0-9]+"), ""))),
        "plus": flag(s.startswith("+")), "bracket": flag(s.rlike(r"[()\[\]{}]")),
        "luhn": flag(F.when(F.length(digits_of(s)).between(13, 19), luhn(s)).otherwise(False)),
        "host_dot": flag(s.rlike(r"@.*[\p{L}\p{N}]\.\p{L}{2,}$")), "says_dot": flag(s.rlike(r"(?i)[^\p{L}]dot[^\p{L}]")),
        "parts_small": flag(F.when(plain.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), small_parts(plain)).otherwise(False)),
        "quoted": flag(before.rlike("[\"']$")), "assigned": flag(before.rlike(r"[=:]\s*[\"']?$")), "named": flag(before.rlike(named)),
        "glued": flag(before.rlike(r"[\p{L}\p{N}_]$") | after.rlike(r"^[\p{L}\p{N}_]")),
        "near_digit": flag(before.rlike(r"[0-9][\x20.-]?$") | after.rlike(r"^[\x20.-]?[0-9]")),
    }


FEATURES = [*[f"is_{g}" for g in GENERATORS], "length", "n_digits", "digit_share", "hex_share", "upper_share", "n_dots", "n_slashes",
            "n_gaps", "n_groups", "plus", "bracket", "luhn", "host_dot", "says_dot", "parts_small", "quoted", "assigned", "named",
            "glued", "near_digit"]


def variants(c: Column) -> Column:
    """Arrays (generator, s, before, after) that rewrite what a base rule or an assignment vouches for; else empty."""
    s, before, after = c["s"], c["before"], c["after"]

    def one(generator: str, form: Column, left: Column = before, right: Column = after) -> Column:
        return F.struct(F.lit(generator).alias("generator"), form.alias("s"), left.alias("before"), right.alias("after"))

    local, host, digits = F.substring_index(s, "@", 1), F.substring_index(s, "@", -1), digits_of(s)
    bare = F.regexp_replace(s, r"^\+", "")
    short = F.regexp_replace(s, r"^\+[0-9]{1,3}[\x20.-]", "")
    by_four = lambda sign: F.regexp_replace(digits, "(.{4})(?=.)", "$1" + sign)
    email = F.array(one("spelled", F.concat(local, F.lit(" [at] "), host)),
                    one("spelled", F.concat(local, F.lit("(at)"), F.replace(host, F.lit("."), F.lit("[dot]")))),
                    one("spelled", F.concat(local, F.lit(" at "), F.replace(host, F.lit("."), F.lit(" dot ")))),
                    one("address", F.concat(local, F.lit("@"), F.translate(host, "aeou", "\u00e4\u00e9\u00f6\u00fc"))))
    grouped = short.rlike(f"^{GENERATORS['grouped']}$")
    phone = F.when(bare.rlike(r"[0-9][\x20().-]+[0-9]"), F.concat(
        F.array(one("digits", bare), one("digits", F.regexp_replace(bare, r"[\x20()-]+", "."))),
        F.when(grouped, F.array(one("digits", short), one("grouped", short), one("grouped", short, before, F.lit(" 1")),
                                one("grouped", short, F.lit("1 "), after), one("grouped", F.regexp_replace(short, r"[()]", ""))))
        .otherwise(F.array().cast(TEXTS))))
    card = F.array(one("digits", by_four(".")), one("digits", by_four("/")), one("run", digits, F.lit("1 "), after),
                   one("run", digits, before, F.lit(" 1")))
    ip = F.array(*[one("dotted", F.replace(s, F.lit("."), F.lit(sign))) for sign in ("[.]", "(.)", " . ", "[dot]", ". ")])
    bare_token = F.array(one("opaque", s, F.lit(""), F.lit("")), one("opaque", s, F.lit(' "'), F.lit('"')))
    return F.coalesce(F.when(c["rule"] == "email", email).when(c["rule"] == "phone", phone).when(c["rule"] == "card", card)
                      .when(c["rule"] == "ip", ip).when(c["rule"] == "secret", bare_token), F.array().cast(TEXTS))


TEXTS = "array<struct<generator:string,s:string,before:string,after:string>>"


def candidates(text: Column, base: Column, doc_id: Column) -> Column:
    """Array of (generator, start, end, kind, x, label, offered, held, order) of one text.

    ``offered`` candidates stand in the text and touch no base span; the others are variants and serve the fit only.
    """
    known = F.concat(*[F.transform(base[k], lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))) for k in BASE_KINDS])
    makers = {"email": "address", "ip": "dotted", "phone": "digits", "card": "digits"}

    def found(generator: str, pattern: str) -> Column:
        spans = find_spans(text, pattern)
        if generator == "spelled":
            spans = F.when(text.rlike(SPELLED), spans).otherwise(F.array().cast("array<struct<start:int,end:int,s:string>>"))

        def row(c: Column) -> Column:
            from_ = F.greatest(c["start"] - AROUND, F.lit(0))
            before = F.substring(text, from_ + 1, c["start"] - from_)
            touches = F.exists(known, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"]))
            rule = F.lit(None).cast("string")
            for kind, maker in makers.items():
                if maker == generator:
                    exact = F.exists(base[kind], lambda k: (k["start"] == c["start"]) & (k["end"] == c["end"]))
                    rule = F.coalesce(rule, F.when(exact, kind))
            if generator == "opaque":
                rule = F.when(before.rlike(ASSIGNED) & ~touches, "secret")
            return F.struct(F.lit(generator).alias("generator"), c["start"].alias("start"), c["end"].alias("end"), c["s"].alias("s"),
                            before.alias("before"), F.substring(text, c["end"] + 1, F.lit(2)).alias("after"),
                            rule.alias("rule"), touches.alias("touches"))

        return F.transform(spans, row)

    def forms(c: Column) -> Column:
        held = F.pmod(F.xxhash64(c["s"], c["before"]), F.lit(FOLDS)) == 0

        def described(v: Column, label: Column, offered: Column, i: Column) -> Column:
            x = features(v["s"], v["before"], v["after"], v["generator"])
            n = F.length(digits_of(v["s"]))
            kind = (F.when(v["generator"].isin("address", "spelled"), "email").when(v["generator"] == "dotted", "ip")
                    .when(v["generator"] == "opaque", "secret").when(n.between(13, 19) & (x["luhn"] == 1.0), "card").otherwise("phone"))
            return F.struct(v["generator"].alias("generator"), c["start"].alias("start"), c["end"].alias("end"), kind.alias("kind"),
                            F.struct(*[x[f].alias(f) for f in FEATURES]).alias("x"), label.cast("double").alias("label"),
                            offered.alias("offered"), held.alias("held"),
                            F.xxhash64(doc_id, c["start"], c["generator"], v["s"], i).alias("order"))

        itself = F.struct(c["generator"].alias("generator"), c["s"].alias("s"), c["before"].alias("before"), c["after"].alias("after"))
        rows = F.concat(F.array(itself), variants(c))
        return F.filter(F.transform(rows, lambda v, i: described(
            v, (i > 0) | F.coalesce(c["rule"] == "secret", F.lit(False)), (i == 0) & ~c["touches"], i)),
            lambda r: r["offered"] | (r["label"] == 1.0))

    return F.flatten(F.transform(F.concat(*[found(g, pattern) for g, pattern in GENERATORS.items()]), forms))


@dataclass
class Selector:
    """Trees as (weight, node) with node = (feature, threshold, left, right) or a leaf value, and thresholds per generator."""

    trees: list
    thresholds: dict[str, float]

    def score(self, x: Column) -> Column:
        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, bound, left, right = node
            return F.when(x[FEATURES[feature]] <= bound, value(left)).otherwise(value(right))

        total = sum((F.lit(float(w)) * value(t) for w, t in self.trees), F.lit(0.0))
        return 1 / (1 + F.exp(-2 * total))


def _tree(node):
    if node.getClass().getSimpleName() == "LeafNode":
        return node.prediction()
    split = node.split()
    return split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild())


def scan(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with ``base`` and ``__candidates``."""
    based = docs.withColumn("base", base_spans(text_of(text)))
    return based.withColumn("__candidates", candidates(text_of(text), F.col("base"), F.col(f"`{doc_id}`")))


def fit_sample(rows: DataFrame, sizes: dict[tuple[str, float], int]) -> DataFrame:
    """The candidates of least hash of each generator and label; ``sizes`` counts them all."""
    most = TRAIN_CANDIDATES // (2 * len(GENERATORS))
    parts = []
    for (generator, label), n in sorted(sizes.items()):
        mine = rows.where((F.col("generator") == generator) & (F.col("label") == label))
        if n > 4 * most:  # hashes are even, so about twice as many as needed lie below
            near = mine.where(F.col("order") < F.lit(-2**63 + 2**65 * most // n))
            mine = near if near.count() >= most else mine
        parts.append(mine.orderBy("order").limit(most))
    return reduce(DataFrame.unionByName, parts)


def _fit(train: DataFrame) -> Selector:
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="v").transform(train.select("x.*", "label"))
    model = GBTClassifier(featuresCol="v", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=7).fit(assembled)
    return Selector([(w, _tree(t._java_obj.rootNode())) for w, t in zip(model.treeWeights, model.trees)], {})


def _bins(rows: DataFrame, selector: Selector) -> list:
    """Candidates by generator, label, fold and score in hundredths: at most 404 rows per generator."""
    return (rows.groupBy("generator", "label", "held", F.floor(selector.score(F.col("x")) * 100).cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")).collect())


def _unclear(table: list, held: dict[str, bool]) -> dict[str, float]:
    """Score per generator from which an unlabelled candidate counts as unclear."""
    out = {}
    for g in held:
        positives = sorted((r["bin"], r["n"]) for r in table if r["generator"] == g and r["label"] == 1 and r["held"] >= held[g])
        spare = SPIES * sum(n for _, n in positives)
        for at, n in positives:
            spare -= n
            if spare < 0:
                out[g] = max(at / 100, FLOOR)
                break
    return out


def fit_selector(rows: DataFrame) -> Selector | None:
    """Fits on a bounded sample and calibrates on all candidates; None where the table lacks candidates of both labels.

    ``rows`` are the documents that ``scan`` made, written to a table.
    """
    # explode proper would make Spark test the array's size first
    rows = rows.select(F.explode_outer("__candidates").alias("c")).where("c IS NOT NULL").select("c.*")
    counts = rows.groupBy("generator", "label", "held").agg(F.count(F.lit(1)).alias("n")).collect()
    ours = {r["generator"]: r["n"] for r in counts if r["held"] and r["label"] == 1}
    held = {g: ours.get(g, 0) >= HELD for g in GENERATORS}
    sizes: dict[tuple[str, float], int] = {}
    for r in counts:
        if not (r["held"] and held[r["generator"]]):
            sizes[r["generator"], r["label"]] = sizes.get((r["generator"], r["label"]), 0) + r["n"]
    if len({label for _, label in sizes}) < 2:
        return None
    fitted = ~F.col("held") | F.col("generator").isin([g for g in GENERATORS if not held[g]])
    train = materialize(fit_sample(rows.where(fitted), sizes).orderBy("order"), "pii-sample")
    first = _fit(train)
    unclear = _unclear(_bins(rows, first), held)
    bound = F.coalesce(*[F.when(F.col("generator") == g, F.lit(t)) for g, t in unclear.items()], F.lit(2.0))
    clear = (F.col("label") == 1) | (F.floor(first.score(F.col("x")) * 100) < F.floor(bound * 100 + 0.5))
    sure = train.where(clear)
    if not sure.where("label = 0").take(1):
        return None
    selector = _fit(sure)
    table = _bins(rows.where(clear), selector)
    for g in GENERATORS:
        n = hits = 0
        best = None
        mine = [r for r in table if r["generator"] == g and r["held"] >= held[g]]
        for at in range(100, 49, -1):
            n += sum(r["n"] for r in mine if r["bin"] == at)
            hits += sum(r["n"] for r in mine if r["bin"] == at and r["label"] == 1)
            if n and hits >= PRECISION * n:
                best = at / 100
        if best is not None:
            selector.thresholds[g] = best
    return selector


def _select(scanned: DataFrame, selector: Selector | None) -> DataFrame:
    """``__candidates`` turned into ``added``."""
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    if selector is None or not selector.thresholds:
        return scanned.withColumn("added", none).drop("__candidates")

    def bound(generator: Column) -> Column:
        return F.coalesce(*[F.when(generator == g, F.lit(t)) for g, t in selector.thresholds.items()], F.lit(2.0))

    picked = F.filter("__candidates", lambda c: c["offered"] & (selector.score(c["x"]) >= bound(c["generator"])))
    spans = F.array_sort(F.array_distinct(F.transform(picked, lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind")))))
    return scanned.withColumn("added", F.transform(spans, lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))).drop("__candidates")


def find_personal_data(docs: DataFrame, selector: Selector | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents with ``base``, spans per base kind, and ``added``, an array of (kind, start, end) ordered by start."""
    scanned = scan(docs, text, doc_id)
    if selector is None:
        scanned = materialize(scanned, "pii-candidates")
        selector = fit_selector(scanned)
    return _select(scanned, selector)


def _shown(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda x: F.concat(F.lit(kind + ":"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))


def personal_data_digest(docs: DataFrame) -> DataFrame:
    scanned = materialize(scan(docs.select("doc_id", "text")).drop("text"), "pii-candidates")
    found = _select(scanned, fit_selector(scanned))
    plain = lambda spans: F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    def every(kind: str) -> Column:
        added = plain(F.filter("added", lambda x: x["kind"] == kind))
        return F.array_sort(F.concat(plain(F.col(f"base.{kind}")), added)) if kind in BASE_KINDS else added

    base = F.array_join(F.concat(*[_shown(k, F.col(f"base.{k}")) for k in BASE_KINDS]), ",")
    return found.select("doc_id", *[F.size(f"base.{k}").cast("bigint").alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(base, 256).alias("base_sha256"),
                        F.array_join(F.concat(*[_shown(k, every(k)) for k in KINDS]), ",").alias("spans"))


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``redacted``: the text with every span replaced by its kind in angle brackets, overlapping ones as one."""
    def named(kind: Column):
        return lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), kind.alias("kind"))

    rows = F.concat(*[F.transform(F.col(f"base.{k}"), named(F.lit(k))) for k in BASE_KINDS], F.transform(
        "added", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    body = text_of(text)
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        put = F.concat(acc["out"], F.substring(body, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0))),
                       F.when(x["start"] >= acc["at"], F.concat(F.lit("<"), x["kind"], F.lit(">"))).otherwise(""))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), put.alias("out"))

    return found.withColumn("redacted", F.aggregate(F.array_sort(rows), zero, add, lambda acc: F.concat(
        acc["out"], F.substring(body, acc["at"] + 1, F.length(body)))))
