"""Personal data: fixed patterns, and identifiers that bootstrapped context patterns discover."""

from __future__ import annotations

import hashlib
import re
from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.llm.common import in_batches, only, parts, slices, span_digest, written
from loomline.session import materialize

KINDS = ["email", "ip", "card", "phone"]
#: A pattern is taken up if so many distinct known instances stand behind it and its score reaches the bound.
LEAST_SEEDS = 5
LEAST_SCORE = 0.8
#: What an unknown instance counts against a pattern, where a known one counts up to 1 for it.
UNKNOWN_WEIGHT = 0.05
#: A context must be followed (or preceded) by a seed or another instance in this share of its places in all texts.
LEAST_PULL = 0.1
#: Contexts that are counted in one reading of the texts; more take more readings.
MOST_CONTEXTS = 100_000
#: Characters that a word of a context has at most.
MOST_WORD = 64
#: Digits that a run of groups has at most to be one identifier; longer ones are lists of numbers.
MOST_RUN_DIGITS = 32

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = " \t\n\x0b\x0c\r"
#: Words of a context: letters and digits, so that quotes, brackets, colons and equals signs make no difference.
_CONTEXT_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_CONTEXT_GAP = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_NUMBER = re.compile(r"[0-9]+")
#: A key name that is joined to its value by = or a colon.
_KEY = re.compile(r"""[^\W\d_][^\W\d]*(?:-[^\W\d]+)*[=:]++["'(\[{<]*+(?!/)""")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: back over the local part, on over the domain. No position is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and _LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                yield start, domain.end()
                done = domain.end()
                at = text.find("@", done)
                continue
        at = text.find("@", at + 1)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end), sorted: leftmost, non-overlapping per kind, no retries."""
    found = []
    if "@" in text:
        found += [(a, 0, b) for a, b in _emails(text)]
    if any(d in text for d in "0123456789"):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:] or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


_DIGIT = re.compile(r"[0-9]+|@")
#: Groups of digits over several words, as people write numbers.
_RUN = re.compile(
    r"""(?<![^\s"'(\[{<:=,;+])\(?[0-9]++(?![\w@])(?:[\x20().-]{1,3}+[0-9]++(?![\w@]))++""")


def _shape(instance: str) -> str:
    """Digits as 9, letters as a, runs once: what an identifier looks like."""
    return re.sub(r"(.)\1+", r"\1", re.sub(r"[^\W\d_]", "a", re.sub(r"[0-9]", "9", instance)))[:40]


def _name(instance: str) -> str:
    """What an instance is joined by: long ones go by their hash."""
    return instance if len(instance) <= 64 else hashlib.sha256(instance.encode("utf-8", "replace")).hexdigest()


class _Surroundings:
    """Words of a text by position. They are found once, when the first context is asked for."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, None, None

    def _word(self, i: int) -> str | None:
        if 0 <= i < len(self.starts) and self.ends[i] - self.starts[i] <= MOST_WORD:
            return _NUMBER.sub("9", self.text[self.starts[i]:self.ends[i]].lower())
        return None

    def contexts(self, start: int, end: int) -> list[dict]:
        """One and two words before and after a place, each with its nearest word alone as core."""
        if self.starts is None:
            self.starts, self.ends = array("q"), array("q")
            for m in _CONTEXT_WORD.finditer(self.text):
                self.starts.append(m.start())
                self.ends.append(m.end())
        i, k, out = bisect_right(self.ends, start) - 1, bisect_left(self.starts, end), []
        near, far = self._word(i), self._word(i - 1)
        if near:
            core = f"{near} _"
            out += [(core, core)] + ([(f"{far} {core}", core)] if far else [])
        near, far = self._word(k), self._word(k + 1)
        if near:
            core = f"_ {near}"
            out += [(core, core)] + ([(f"{core} {far}", core)] if far else [])
        return [dict(zip(("context", "core"), x)) for x in out]


def count_contexts(texts: list[str], wanted: frozenset[tuple[str, ...]]) -> Counter:
    """How often each wanted word, or pair of words, stands in the texts."""
    found = Counter()
    for text in texts:
        at, last = 0, []
        while at < len(text):  # in pieces that end between two words
            gap = _CONTEXT_GAP.search(text, at + (1 << 20))
            end = gap.end() if gap else len(text)
            words = _CONTEXT_WORD.findall(_NUMBER.sub("9", text[at:end].lower()))
            found.update(filter(wanted.__contains__, zip(words)))
            found.update(filter(wanted.__contains__, zip(last + words, words if last else words[1:])))
            at, last = end, words[-1:] or last
    return found


def occurrences(text: str, base: list[tuple[int, int, int]]) -> list[dict]:
    """Seeds, and other tokens that hold a digit or an @, each with its contexts: words before and after it.

    A token is cut at white space and freed from punctuation around it and from a key name before = or a
    colon; groups of digits joined by spaces, dots, hyphens or brackets are one token. Those that meet a
    base span, and places without a word beside them, are left out.
    """
    out, around = [], _Surroundings(text)
    for start, kind, end in base:
        contexts = around.contexts(start, end)
        if contexts:
            out.append((start, end, KINDS[kind], contexts, text[start:end].lower(), True))
    taken, i, done = sorted((a, b) for a, _, b in base), 0, -1
    runs = _RUN.finditer(text)
    run = next(runs, None)

    def free(start: int, end: int) -> bool:
        nonlocal i
        while i < len(taken) and taken[i][1] <= start:
            i += 1
        return not any(a < end and start < b for a, b in taken[i:i + 4])

    for m in _DIGIT.finditer(text):
        if m.start() < done:
            continue
        while run and run.end() <= m.start():
            run = next(runs, None)
        if run and done <= run.start() <= m.start() and " " in run.group() \
                and len(_digits(run.group())) <= MOST_RUN_DIGITS and free(*run.span()):
            start, end = run.span()
            body, done = run.group(), end
        else:
            start = m.start()
            while start > 0 and text[start - 1] not in _SPACE and start > done:
                start -= 1
            word = _WORD.match(text, start)
            done = word.end()
            token = word.group()
            lead = len(token) - len(token.lstrip("\"'([{<.,:;!?+="))
            key = _KEY.match(token, lead)
            if key and _DIGIT.search(token, key.end()):
                lead = key.end()
            body = token[lead:].rstrip("\"')]}>.,:;!?=")
            start, end = start + lead, start + lead + len(body)
            if not _DIGIT.search(body) or not free(start, end):
                continue
        contexts = around.contexts(start, end)
        if contexts:
            out.append((start, end, None, contexts, body.lower(), False))
    names = ("start", "end", "kind", "contexts", "instance", "seed")
    return [dict(zip(names, x)) | {"instance": _name(x[4]), "shape": _shape(x[4][:4096])} for x in out]


_OCCURRENCES = pa.list_(pa.struct([
    ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()),
    ("contexts", pa.list_(pa.struct([("context", pa.string()), ("core", pa.string())]))),
    ("instance", pa.string()), ("seed", pa.bool_()), ("shape", pa.string())]))
_BASE = pa.list_(pa.struct([("start", pa.int32()), ("place", pa.int32()), ("end", pa.int32())]))


def read(docs: DataFrame) -> DataFrame:
    """doc_id, base and occurrences of every whole text; null texts count as empty."""
    rows = only(docs, "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            texts = [t or "" for t in piece.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            seen = [occurrences(t, b) for t, b in zip(texts, base)]
            named = [[dict(zip(("start", "place", "end"), x)) for x in b] for b in base]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(named, _BASE), pa.array(seen, _OCCURRENCES)],
                ["doc_id", "base", "occurrences"])

    return in_batches(rows, run, f"doc_id {kind}, base array<struct<start:int,place:int,end:int>>, occurrences "
        "array<struct<start:int,end:int,kind:string,contexts:array<struct<context:string,core:string>>,"
        "instance:string,seed:boolean,shape:string>>")


def _shapes() -> Column:
    """The shapes that a context of an occurrence o stands with: the occurrence's, and '' for any."""
    return F.array(F.lit(""), F.col("o.shape"))


def edges(found: DataFrame) -> DataFrame:
    """The graph: (context, core, shape, instance, seed, kind, other_kind, n), summed before the shuffle.

    A pattern is a pair of context and shape; its kind is that of the seeds it stands with. Contexts are
    one or two words before an instance, or after it. Each occurrence gives one edge per pattern.
    Instances are compared in lower case.
    """
    one = found.select(F.explode("occurrences").alias("o")).select("o", F.explode("o.contexts").alias("c"))
    return one.select("c.context", "c.core", F.explode(_shapes()).alias("shape"), "o.instance", "o.seed", "o.kind").groupBy(
        "context", "core", "shape", "instance").agg(
        F.max("seed").alias("seed"), F.max("kind").alias("kind"), F.min("kind").alias("other_kind"),
        F.count(F.lit(1)).alias("n"))


def bootstrap(links: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Patterns that are taken up, with kind and score, from the graph's edges.

    An instance is known if it is a seed (weight 1), or stands with a pattern that is taken up (weight:
    the best such score), of one kind only. For a pattern only what a context with another nearest word (or
    the other side) made known counts, so none confirms itself. A pattern's score is the weight of its known
    instances over that weight, one, and UNKNOWN_WEIGHT for every other instance; it is taken up with
    LEAST_SEEDS known instances, all of one kind, and ``least_score``. Every round looks at all patterns
    again, until one takes up no new pattern, and so no new instance. What is taken up stays, so this ends.
    """
    known, taken, before = None, None, 0
    while True:
        seen = links.withColumns({
            "most": F.col("kind"), "least": F.col("other_kind"),
            "weight": F.when(F.col("seed"), 1.0)})
        if known is not None:
            elsewhere = ~F.col("seed") & ((F.col("first") != F.col("core")) | (F.col("last") != F.col("core")))
            seen = links.join(known, "instance", "left").withColumns({
                "most": F.coalesce("kind", F.when(elsewhere, F.col("known_kind"))),
                "least": F.coalesce("other_kind", F.when(elsewhere, F.col("known_kind"))),
                "weight": F.when(F.col("seed"), 1.0).when(elsewhere, F.col("known_weight"))})
        rated = seen.groupBy("context", "shape").agg(
            F.count("weight").alias("n_known"), F.coalesce(F.sum("weight"), F.lit(0.0)).alias("sum"),
            F.count(F.lit(1)).alias("n"), F.max("most").alias("new_kind"), F.min("least").alias("least_kind"),
        ).filter((F.col("n_known") >= LEAST_SEEDS) & (F.col("new_kind") == F.col("least_kind"))).select(
            "context", "shape", "new_kind",
            (F.col("sum") / (F.col("sum") + 1 + UNKNOWN_WEIGHT * (F.col("n") - F.col("n_known")))).alias("new_score"),
        ).filter(F.col("new_score") >= least_score)
        if taken is None:
            taken = rated.select("context", "shape", F.col("new_kind").alias("kind"), F.col("new_score").alias("score"))
        else:
            taken = taken.join(rated, ["context", "shape"], "full").select(
                "context", "shape", F.coalesce("kind", "new_kind").alias("kind"),
                F.coalesce("score", "new_score").alias("score"))
        taken = materialize(taken)
        n = taken.count()
        if n == before:
            return taken
        before = n
        known = materialize(links.filter(~F.col("seed")).select("context", "core", "shape", "instance").join(
            taken, ["context", "shape"]).groupBy("instance").agg(
                F.max("kind").alias("known_kind"), F.min("kind").alias("other"), F.max("score").alias("known_weight"),
                F.min("core").alias("first"), F.max("core").alias("last"),
            ).filter("known_kind = other").drop("other"))


def places(docs: DataFrame, contexts: DataFrame) -> DataFrame:
    """(context, total): in how many places of all whole texts the words of each context stand.

    At most about MOST_CONTEXTS contexts, of two short words each, go to the tasks at a time; there are as
    many readings of the texts as that takes. A task sends one row per context it met.
    """
    spark, counted = docs.sparkSession, None
    blocks = parts(contexts.count(), MOST_CONTEXTS)
    for block in range(blocks):
        mine = contexts.filter(F.pmod(F.xxhash64("context"), F.lit(blocks)) == block).collect()
        names: dict[tuple[str, ...], list[str]] = {}
        for r in mine:
            names.setdefault(tuple(r["context"].removeprefix("_ ").removesuffix(" _").split(" ")), []).append(r["context"])
        shared = spark.sparkContext.broadcast(names)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            wanted, found = frozenset(shared.value), Counter()
            for piece in slices(batches):
                found.update(count_contexts([t for t in piece.column("text").to_pylist() if t], wanted))
            rows = [(name, n) for words, n in found.items() for name in shared.value[words]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.int64())],
                ["context", "total"])

        part = written(in_batches(only(docs, "text"), run, "context string, total bigint").groupBy("context").agg(
            F.sum("total").alias("total")), "pii-places")
        counted = part if counted is None else counted.unionByName(part)
    return counted


def patterns(docs: DataFrame, graph: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Patterns taken up whose contexts are drawn to identifiers.

    The graph alone can't tell "phone" from "the": in a large corpus some seeds stand behind every
    frequent word. So the contexts that a first bootstrapping takes up are counted in the texts; only
    those that stand beside an instance in LEAST_PULL of their places go into the final bootstrapping.
    """
    links = materialize(graph)
    first = bootstrap(links, least_score)
    contexts = first.select("context").distinct()
    if contexts.isEmpty():
        return first
    beside = links.join(contexts, "context", "left_semi").groupBy("context", "shape").agg(F.sum("n").alias("n")) \
        .groupBy("context").agg(F.sum(F.when(F.col("shape") != "", F.col("n"))).alias("n"))
    drawn = beside.join(places(docs, contexts), "context").filter(F.col("n") >= LEAST_PULL * F.col("total"))
    return bootstrap(materialize(links.join(drawn.select("context"), "context", "left_semi")), least_score)


def find(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Personal data of every whole text: doc_id, base and spans (arrays of kind, start, end).

    Positions are code points; both arrays are sorted by start, then by the kinds' order. base are
    the fixed patterns' matches, spans has also the tokens that stand beside a high-scoring context
    pattern, with that pattern's kind. Null and empty texts have none. Rows stay as they are, also
    repeated ones and those without doc_id; an empty table gives an empty table.

    What is written are spans and tokens with digits. The texts are read once more to count the contexts
    that come into question. Patterns and discovered tokens meet by joins on the context, which are as
    small as the tokens are rare.
    """
    seen = written(read(docs).select(F.monotonically_increasing_id().alias("row"), "*"), "pii")
    taken = patterns(docs, edges(seen), least_score)
    tokens = seen.select("row", F.explode("occurrences").alias("o")).filter("not o.seed").select(
        "row", "o", F.explode("o.contexts").alias("c")).select(
        "row", "c.context", F.explode(_shapes()).alias("shape"), "o.start", "o.end")
    hits = tokens.join(taken.select("context", "shape", "kind", "score"), ["context", "shape"])
    order = F.element_at(F.create_map(*[F.lit(x) for k, v in enumerate(KINDS) for x in (v, k)]), F.col("kind"))
    # one kind per token: that of the best pattern
    best = hits.groupBy("row", "start", "end").agg(
        F.max(F.struct("score", (-order).alias("low"))).alias("best"))
    added = best.groupBy("row").agg(F.collect_list(F.struct(
        "start", (-F.col("best.low")).cast("int").alias("place"), "end")).alias("added"))
    both = seen.select("row", "doc_id", "base").join(added, "row", "left")
    named = lambda spans: F.transform(F.array_sort(spans), lambda s: F.struct(
        F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["place"] + 1).alias("kind"),
        s["start"].alias("start"), s["end"].alias("end")))
    empty = F.array().cast("array<struct<start:int,place:int,end:int>>")
    return both.select("doc_id", named(F.col("base")).alias("base"),
                       named(F.concat("base", F.coalesce("added", empty))).alias("spans"))


def op1_pii(spark, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(span_digest(F.col("base")), 256).alias("base_sha256"),
        span_digest(F.col("spans")).alias("spans"))
