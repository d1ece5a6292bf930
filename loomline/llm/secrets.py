"""Secret scan: fixed patterns, and a battery of randomness tests for other long tokens."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import only, span_digest, written

#: Kinds with fixed patterns, in the order in which spans with equal starts are listed.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
#: Tokens that the randomness tests look at, if WORTH fits, and what stands in them between the separators of either
#: encoding or both: a key in a path, or behind a name, is tested alone too.
TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
PARTS = {"url": r"[A-Za-z0-9_-]{20,}={0,2}", "std": r"[A-Za-z0-9+/]{20,}={0,2}", "bare": r"[A-Za-z0-9]{20,}={0,2}"}
#: A digit and a letter, or letters of both cases as no word has them: five small and five capital ones.
WORTH = r"^(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])|^(?=(?:[^a-z]*[a-z]){5})(?=(?:[^A-Z]*[A-Z]){5})"
MASK = "[SECRET]"
KINDS = ["assign", "access", "hex", "random"]
#: Alphabets by encoding; the first that holds all characters of a token is inferred.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: For evidence against words: a base62 token without a digit is told by its letters alone.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: Share of wrong rejections among the tokens that are rejected as not random.
FALSE_DISCOVERIES = 0.01
#: Classes of characters: small vowels and consonants, capital letters, digits, and separators.
CLASSES = {"v": "aeiouy", "c": "bcdfghjklmnpqrstvwxz", "U": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "d": "0123456789", "o": "+/-_"}
#: How often a word ends at a character of a name such as setUserName2, whatever the corpus says.
WORD_END = 0.15
#: What the words of any text are like, as counts beside those of the corpus: pairs of classes.
USUAL_PAIRS = {"vv": 60, "vc": 430, "vU": 5, "vd": 5, "cv": 250, "cc": 240, "cU": 5, "cd": 5, "Uv": 130, "Uc": 170,
               "UU": 180, "Ud": 20, "dv": 10, "dc": 20, "dU": 15, "dd": 300}
#: Letters of a thousand of any text, counted beside those of the corpus, and the weight of both
#: together against all letters alike.
USUAL_LETTERS = {"a": 82, "b": 15, "c": 28, "d": 43, "e": 127, "f": 22, "g": 20, "h": 61, "i": 70, "j": 2, "k": 8,
                 "l": 40, "m": 24, "n": 67, "o": 75, "p": 19, "q": 1, "r": 60, "s": 63, "t": 91, "u": 28, "v": 10,
                 "w": 24, "x": 2, "y": 20, "z": 1}
LETTER_WEIGHT = 0.8
#: Share of joined words among the tokens that are taken for secrets.
WORDS_AMONG_SECRETS = 0.05
#: Steps per unit in which logarithms of evidence are counted.
STEPS_PER_NAT = 8
#: Steps per power of ten in which p-values are counted, and the number of steps.
STEPS_PER_TEN, MOST_STEPS = 50, 1000
BLOCK = 256
#: Spans that are looked through at once for those that meet another.
SPAN_BLOCK = 64


def _running(lengths: Column, blocks: Column, i: Column) -> Column:
    """Sum of the first i lengths: whole blocks, then what is left."""
    block = F.floor(i / BLOCK).cast("int")
    add = lambda a, x: a + x
    return F.get(blocks, block) + F.aggregate(
        F.slice(lengths, block * BLOCK + 1, i - block * BLOCK), F.lit(0), add)


def _block_sums(lengths: Column) -> Column:
    many = F.sequence(F.lit(0), F.floor(F.size(lengths) / BLOCK).cast("int"))
    return F.transform(many, lambda b: F.aggregate(
        F.slice(lengths, b * BLOCK + 1, BLOCK), F.lit(0), lambda a, x: a + x))


def _before(sums: Column) -> Column:
    """At b: the sum of the block sums before b."""
    return F.transform(sums, lambda _, b: F.aggregate(
        F.slice(sums, F.lit(1), b), F.lit(0), lambda a, x: a + x))


def find_all(docs: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Add per pattern an array of (start, end, match): leftmost matches that don't overlap.

    Positions are code points: the matches and the gaps between them add up to the text. Texts
    that ``worth`` (the second of the pair) rules out are not searched. Sums go by blocks, so many
    matches in a text don't cost the square of their number.
    """
    found = docs.select("*", *[
        F.when(worth, F.regexp_extract_all("text", F.lit(p), F.lit(0))).alias(f"_{k}")
        for k, (p, worth) in patterns.items()])
    none = F.array().cast("array<string>")
    gaps = found.select("*", *[
        F.when(F.size(f"_{k}") > 0, F.split("text", p, -1)).otherwise(none).alias(f"_{k}_gaps")
        for k, (p, _) in patterns.items()])
    def ends(k: str) -> Column:
        return F.transform(f"_{k}_gaps", lambda g, i: F.length(g) + F.coalesce(
            F.length(F.get(f"_{k}", i)), F.lit(0)))

    sizes = gaps.select(*found.columns, *[ends(k).alias(f"_{k}_ends") for k in patterns])
    sums = sizes.select("*", *[_block_sums(F.col(f"_{k}_ends")).alias(f"_{k}_each") for k in patterns])
    blocks = sums.select("*", *[_before(F.col(f"_{k}_each")).alias(f"_{k}_sums") for k in patterns])

    def spans(k: str) -> Column:
        def span(m: Column, i: Column) -> Column:
            end = _running(F.col(f"_{k}_ends"), F.col(f"_{k}_sums"), i + 1)
            return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("match"))

        return F.coalesce(F.transform(f"_{k}", span),
                          F.array().cast("array<struct<start:int,end:int,match:string>>"))

    return blocks.select(*docs.columns, *[spans(k).alias(k) for k in patterns])


def normal_tail(z: Column) -> Column:
    """P(|Z| >= |z|), absolute error below 2e-7 (a well-known rational approximation of erfc)."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x * 0.3275911)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (
        -1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), F.greatest(poly * F.exp(-x * x), F.lit(1e-20)))


def encoding_of(body: Column) -> Column:
    """The first of ALPHABETS that holds all characters; null where none does."""
    out = F.lit(None).cast("string")
    for name, chars in reversed(ALPHABETS.items()):
        out = F.when(F.translate(body, chars, "") == "", name).otherwise(out)
    return out


def randomness(token: Column) -> Column:
    """Struct (stratum, p) of a token: p is small if it isn't random text of its encoding.

    Over the symbols' places in the inferred alphabet: chi-squared uniformity, runs about the
    middle, and lag-one serial correlation, combined by Fisher's method. The stratum is the
    encoding and the power of two of the length. Null where no alphabet fits.
    """
    body = F.rtrim(token, F.lit("="))
    encoding = encoding_of(body)
    alphabet = F.element_at(F.create_map(*[F.lit(x) for item in ALPHABETS.items() for x in item]), encoding)

    def tests(s: Column) -> Column:
        """Of a struct: body, encoding, alphabet."""
        n, k = F.length(s["body"]).cast("double"), F.length(s["alphabet"]).cast("double")
        letters = F.split(s["body"], "")
        places = F.transform(letters, lambda c: F.instr(s["alphabet"], c).cast("double"))
        squares = F.aggregate(F.array_distinct(letters), F.lit(0.0), lambda a, c: a + F.pow(
            n - F.length(F.replace(s["body"], c, F.lit(""))), F.lit(2.0)))
        chi, free = k / n * squares - n, k - 1
        z_chi = (F.pow(F.greatest(chi, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(
            2 / (9 * free))
        # running over the places: sum, squares, products with the one before, runs, those above
        zero = F.struct(*[F.lit(0.0).alias(c) for c in ("last", "sum", "sq", "prod", "runs", "high")])

        def step(a: Column, x: Column) -> Column:
            high, was = x * 2 > k + 1, a["last"] * 2 > k + 1
            return F.struct(
                x.alias("last"), (a["sum"] + x).alias("sum"), (a["sq"] + x * x).alias("sq"),
                (a["prod"] + x * a["last"]).alias("prod"),
                (a["runs"] + F.when((a["last"] == 0) | (high != was), 1.0).otherwise(0.0)).alias("runs"),
                (a["high"] + F.when(high, 1.0).otherwise(0.0)).alias("high"))

        def ended(a: Column) -> Column:
            low = n - a["high"]
            expected = 2 * a["high"] * low / n + 1
            spread = (expected - 1) * (expected - 2) / (n - 1)
            z_runs = F.when(spread > 0, (a["runs"] - expected) / F.sqrt(spread)).otherwise(F.sqrt(n))
            mean = a["sum"] / n
            variance = a["sq"] - n * mean * mean
            first = F.element_at(places, 1)
            # of x_i x_(i+1) about the mean, from the sums
            lagged = a["prod"] - mean * (2 * a["sum"] - first - a["last"]) + (n - 1) * mean * mean
            z_serial = F.when(variance > 0, (lagged / variance + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n))
            logs = F.log(normal_tail(z_chi)) + F.log(normal_tail(z_runs)) + F.log(normal_tail(z_serial))
            p = F.exp(logs) * (1 - logs + logs * logs / 2)  # chi-squared with six degrees of freedom
            return F.greatest(p, F.lit(1e-20))

        return F.when(s["encoding"].isNotNull(), F.struct(
            F.concat_ws(":", s["encoding"], F.floor(F.log2(n)).cast("string")).alias("stratum"),
            F.aggregate(places, zero, step, ended).alias("p")))

    one = F.array(F.struct(body.alias("body"), encoding.alias("encoding"), alphabet.alias("alphabet")))
    return F.get(F.transform(one, tests), 0)


def cut_offs(tested: DataFrame, level: float = FALSE_DISCOVERIES) -> dict[str, float]:
    """By stratum the p-value up to which tokens are rejected as not random.

    The step-up rule of Benjamini and Hochberg in each stratum of like length and encoding, over
    counts of p-values in steps of a fiftieth of a power of ten. At most (encodings x 31) strata
    of MOST_STEPS counts; no row is sorted and nothing grows with the number of tokens.
    """
    step = F.greatest(F.lit(0), F.least(F.lit(MOST_STEPS - 1), F.floor(
        -F.log10("p") * STEPS_PER_TEN))).cast("int")
    counts = tested.groupBy("stratum", step.alias("step")).count()
    up = Window.partitionBy("stratum").orderBy(F.desc("step"))
    ranked = counts.select(
        "stratum", "step", F.sum("count").over(up).alias("rank"),
        F.sum("count").over(Window.partitionBy("stratum")).alias("m"),
        F.pow(F.lit(10.0), -F.col("step") / STEPS_PER_TEN).alias("largest_p"))
    passed = ranked.filter(F.col("largest_p") <= level * F.col("rank") / F.col("m"))
    return {r[0]: r[1] for r in passed.groupBy("stratum").agg(F.max("largest_p")).collect()}


def class_steps(texts: DataFrame) -> dict[str, float]:
    """What words are like, over all texts: by pair of classes xy (of v, c, U, d) the share of y among
    what follows x, and by small letter its share among those of its class.

    Tokens that are tested are left out, USUAL_PAIRS are added. Pairs of different classes are counted
    as strings, those of one class by what is left, so a text is read a few times in the JVM and one
    row comes back.
    """
    others = F.when(F.col("text").rlike(TOKEN), F.regexp_replace("text", TOKEN, " ")).otherwise(F.col("text"))
    words = F.translate(
        F.concat(F.lit(" "), F.regexp_replace(others, "[^A-Za-z0-9]+", " ")),
        "".join(CLASSES[c] for c in "vcUd"), "".join(c * len(CLASSES[c]) for c in "vcUd"))
    held = texts.select(words.alias("w"), others.alias("t"))

    def number(x: str, of: str = "w") -> Column:
        return F.sum((F.length(of) - F.length(F.replace(of, F.lit(x), F.lit("")))) / len(x))

    pairs = [x + y for x in " vcUd" for y in "vcUd" if x != y]
    names = ["v", "c", "U", "d", *pairs]  # columns by place: names of columns ignore case
    counted = [number(x) for x in names] + [number(x, "t") for x in USUAL_LETTERS]
    found = held.agg(*[x.alias(f"_{i}") for i, x in enumerate(counted)]).first()
    count = {k: float(n or 0) for k, n in zip(names, found)}
    letters = {x: float(n or 0) + USUAL_LETTERS[x] for x, n in zip(USUAL_LETTERS, found[len(names):])}
    for y in "vcUd":
        count[y + y] = count[y] - sum(count[x + y] for x in " vcUd" if x != y)
    out = {}
    for x in "vcUd":
        of = {x + y: count[x + y] + USUAL_PAIRS[x + y] for y in "vcUd"}
        out |= {pair: n / sum(of.values()) for pair, n in of.items()}
    for x in "vc":
        total = sum(letters[c] for c in CLASSES[x])
        out |= {c: LETTER_WEIGHT * letters[c] / total + (1 - LETTER_WEIGHT) / len(CLASSES[x]) for c in CLASSES[x]}
    return out


def evidence(body: Column, encoding: Column, steps: dict[str, float]) -> Column:
    """Logarithm of how much likelier a token is as random text of its encoding than as joined words.

    Of joined words a class of characters follows another as in the words of the corpus, and letters
    are as frequent as there, or, where a word ends, any
    class alike; behind a separator a word begins. Words may also be in capitals throughout: what
    speaks less for a secret counts. The ratio is an e-value: its mean is one at most over joined words.
    """
    def word(pair: str, capitals: bool) -> float:
        x, y = pair
        if x == "o":
            return 0.04 if y == "o" else 0.24
        if capitals and y in "vcU":  # a capital letter goes on as a small one does, a small one is rare
            small = sum(steps[("c" if x == "U" else x) + z] for z in "vc") if x in "Ud" else 0.0
            like = small if y == "U" else 0.0
        else:
            like = steps.get(pair, 0.0)
        return (1 - WORD_END) * like + WORD_END / len(CLASSES)

    def table(capitals: bool) -> Column:
        weights = {}
        for name, chars in (ALPHABETS | {"letters": LETTERS}).items():
            shares = {c: sum(x in of for x in chars) / len(chars) for c, of in CLASSES.items()}
            weights |= {f"{name}:{x}{y}": math.log(shares[y] / word(x + y, capitals))
                        for x in CLASSES for y in CLASSES if shares[x] and shares[y]}
        return F.create_map(*[F.lit(v) for item in weights.items() for v in item])

    encoding = F.when((encoding == "base62") & ~body.rlike("[0-9]"), "letters").otherwise(encoding)
    classes = F.translate(body, "".join(CLASSES.values()), "".join(c * len(of) for c, of in CLASSES.items()))
    one = F.array(F.struct(classes.alias("c"), F.concat(encoding, F.lit(":")).alias("e")))

    letters = {c: math.log(1 / len(CLASSES[x]) / steps[c]) for x in "vc" for c in CLASSES[x]}

    def against(capitals: bool) -> Column:
        weights = table(capitals)
        each = F.create_map(*[F.lit(v) for c, w in letters.items() for v in (c.upper() if capitals else c, w)])
        pairs = F.get(F.transform(one, lambda s: F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.length(s["c"]) - 1, F.lit(1))), F.lit(0.0),
            lambda a, i: a + F.coalesce(F.element_at(
                weights, F.concat(s["e"], F.substring(s["c"], i, 2))), F.lit(0.0)))), 0)
        return pairs + F.aggregate(F.split(body, ""), F.lit(0.0), lambda a, c: a + F.coalesce(
            F.element_at(each, c), F.lit(0.0)))

    return F.least(against(False), against(True))


def least_evidence(tested: DataFrame, level: float = WORDS_AMONG_SECRETS) -> float:
    """The evidence from which on tokens are taken for secrets rather than joined words.

    The step-up rule for e-values over all tokens: with k of m tokens at or above it, it is at least
    the logarithm of m / (level * k). Over counts in steps; infinite if no token has enough.
    """
    step = F.floor(F.col("evidence") * STEPS_PER_NAT).cast("int")
    counts = sorted(tested.groupBy(step.alias("step")).count().collect(), reverse=True)  # one row a step
    m, above, out = sum(r["count"] for r in counts), 0, math.inf
    for r in counts:
        above += r["count"]
        if r["step"] / STEPS_PER_NAT >= math.log(m / (level * above)):
            out = r["step"] / STEPS_PER_NAT
    return out


def _blocks_of(spans: Column) -> Column:
    """Sorted spans in blocks, each with its first start and last end, so that most are passed over."""
    parts_ = F.when(F.size(spans) > 0, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / SPAN_BLOCK).cast("int")),
        lambda b: F.slice(spans, b * SPAN_BLOCK + 1, F.lit(SPAN_BLOCK)))).otherwise(F.array())
    return F.transform(parts_, lambda p: F.struct(
        p.alias("spans"), F.get(p, 0)["start"].alias("first"), F.array_max(F.transform(p, lambda s: s["end"])).alias("last")))


def _meets(blocks: str, start: Column, end: Column, also) -> Column:
    """Whether a span in blocks overlaps [start, end) and ``also`` holds of it."""
    return F.exists(blocks, lambda b: (b["first"] < end) & (start < b["last"]) & F.exists(
        b["spans"], lambda s: (s["start"] < end) & (start < s["end"]) & also(s)))


def _scan(rows: DataFrame, level: float, drop: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``rows`` (text among them, not null) with base and spans."""
    carried = rows.columns
    token = F.col("text").rlike(TOKEN)
    divided = token & F.col("text").rlike("[+/_-]")
    found = find_all(rows, {
        "assign": (ASSIGN, F.col("text").rlike("[:=]")),
        "access": (ACCESS, F.contains("text", F.lit("AKIA"))),
        "hex": (HEX, F.lit(True)),
        "random": (TOKEN, token)} | {k: (p, divided) for k, p in PARTS.items()})
    kept = {
        "assign": lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 1)) >= 12,
        "access": lambda s: F.lit(True), "hex": lambda s: F.lit(True),
        "random": lambda s: s["match"].rlike(WORTH),
    }
    named = lambda k: lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(k)).alias("place"), s["end"].alias("end"),
        F.lit(k).alias("kind"))
    sorted_ = found.select(
        *carried,
        F.array_sort(F.concat(*[F.transform(F.filter(k, kept[k]), named(k)) for k in KINDS[:3]])).alias("base"),
        F.filter(F.array_distinct(F.concat("random", *PARTS)), kept["random"]).alias("random"))
    free = sorted_.withColumn("blocks", _blocks_of(F.col("base"))).select(*carried, "base", F.filter(
        "random", lambda r: ~_meets("blocks", r["start"], r["end"], lambda s: F.lit(True))).alias("random"))
    steps = class_steps(rows)
    body = lambda r: F.rtrim(r["match"], F.lit("="))
    tested = written(free.select(*[c for c in carried if c not in drop], "base", F.filter(
        F.transform("random", lambda r: F.struct(
            r["start"].alias("start"), F.lit(3).alias("place"), r["end"].alias("end"),
            F.lit("random").alias("kind"), randomness(r["match"]).alias("test"),
            evidence(body(r), encoding_of(body(r)), steps).alias("evidence"))),
        lambda r: r["test"].isNotNull()).alias("random")), "secrets")
    tokens = tested.select(F.explode("random").alias("r"))
    cuts = cut_offs(tokens.select("r.test.*"), level)
    enough = least_evidence(tokens.select("r.evidence"))
    rejected = F.lit(False)
    stands = lambda r: (r["evidence"] >= enough) & ~F.coalesce(_any(
        [(r["test"]["stratum"] == s) & (r["test"]["p"] <= p) for s, p in sorted(cuts.items())],
        rejected), rejected)
    strip = lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    # of tokens in one another only the longest
    longest = lambda r: ~_meets("blocks", r["start"], r["end"], lambda o: (
        o["start"] <= r["start"]) & (r["end"] <= o["end"]) & (o["end"] - o["start"] > r["end"] - r["start"]))
    added = F.transform(F.filter("standing", longest), lambda r: F.struct(*[
        r[c].alias(c) for c in ("start", "place", "end", "kind")]))
    standing = tested.withColumn("standing", F.array_sort(F.filter("random", stands)))
    return standing.withColumn("blocks", _blocks_of(F.col("standing"))).select(
        *[c for c in carried if c not in drop], F.transform("base", strip).alias("base"),
        F.transform(F.array_sort(F.concat("base", added)), strip).alias("spans"))


def scan(docs: DataFrame, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """Find secrets in every text (null: empty).

    Columns: doc_id, base and spans (arrays of kind, start, end; positions in code points, sorted
    by start, then kind). base has the kinds assign, access and hex; spans has also ``random``: long
    tokens, or parts of them, that fit WORTH, that the battery does not reject as random text, that
    evidence tells from joined words (both with false-discovery control over all tokens of the
    table) and that no base span meets.
    Rows stay as they are, repeated ones and those without doc_id too; no texts are in the result.
    An empty table gives an empty table.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = only(docs, "doc_id", "text").select("doc_id", text.alias("text"))
    return _scan(rows, level, drop=("text",))


def redact(docs: DataFrame, mask: str = MASK, level: float = FALSE_DISCOVERIES) -> DataFrame:
    """``docs`` with each secret (overlapping spans are one) replaced by ``mask``; n_chars follows the text.

    All rows and columns stay; texts without a secret, and null ones, are as before. The table is
    written once between the search and the replacement.
    """
    text_at = docs.columns.index("text")
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    found = _scan(rows.withColumn("text", F.coalesce(F.col(f"c{text_at}"), F.lit(""))), level, drop=("text",))
    text = F.col(f"c{text_at}")
    start = F.struct(F.lit(0).alias("upto"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        new = s["start"] >= a["upto"]
        return F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            F.when(new, F.concat(a["out"], F.substring(text, a["upto"] + 1, s["start"] - a["upto"]),
                                 F.lit(mask))).otherwise(a["out"]).alias("out"))

    clean = F.aggregate("spans", start, step, lambda a: F.concat(
        a["out"], F.substring(text, a["upto"] + 1, F.length(text))))
    masked = found.withColumn("clean", F.when(F.size("spans") > 0, clean).otherwise(text))
    columns = [F.col(f"c{i}") for i in range(len(docs.columns))]
    columns[text_at] = F.col("clean")
    if "n_chars" in docs.columns:
        at = docs.columns.index("n_chars")
        kind = docs.schema["n_chars"].dataType
        columns[at] = F.when(F.size("spans") > 0, F.length("clean").cast(kind)).otherwise(columns[at])
    return masked.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).toDF(*docs.columns)


def _any(conditions: list[Column], none: Column) -> Column:
    out = none
    for c in conditions:
        out = out | c
    return out


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(span_digest(F.col("base")), 256).alias("base_sha256"),
        span_digest(F.col("spans")).alias("spans"))
