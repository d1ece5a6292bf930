"""N-gram Jaccard join: exact links by an index with block skips and answers from similar sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.llm.common import in_batches, only, parts, release_memory, slices, text_bytes, written
from loomline.llm.graph import components
from loomline.llm.words import mix, pack, shingle_sets, unpack
from loomline.session import materialize

SHINGLE = 5
#: 100 * intersection >= PERCENT * union
PERCENT = 75
#: Text whose shingles a task counts together before they are dealt out.
CHUNK_BYTES = 8 << 20
#: Text per share of the hash space (a power of two of shares is used).
SHARE_BYTES = 16 << 20
#: Bits of a shingle's hash by which it is dealt out and compared.
HASH_BITS = 48
#: Shingles of sets that are joined in one piece; larger groups are joined block by block.
PIECE_SHINGLES = 2_000_000
#: Shingles of a group from which on its sets are compared with one of them, its leader, first.
LED_SHINGLES = 10_000


def least_overlap(m: int, n: int, percent: int = PERCENT) -> int:
    """Fewest common elements with which sets of m and n elements link."""
    return -(-percent * (m + n) // (100 + percent))


def fingerprint(shingles: np.ndarray) -> int:
    """64 bits of a set; equal for equal sets."""
    total = np.array([mix(shingles).sum(dtype=np.uint64) + np.uint64(len(shingles))])
    return int(mix(total).view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and fp (null for an empty set) of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            sets = shingle_sets(piece.column("text"), SHINGLE)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())],
                ["doc_id", "n_shingles", "fp"])

    return in_batches(docs, run, "doc_id bigint, n_shingles bigint, fp bigint")


def _deal(docs: DataFrame, bits: int) -> DataFrame:
    """Shingles by share of the hash space: (share, sets, hashes, who), packed by chunk of text.

    sets are fingerprints, hashes ascend (repeated if in several sets), who are places in sets.
    Equal sets of a chunk are one.
    """
    def emit(sets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        fps = np.array(list(sets), np.int64)
        if not len(fps):
            return
        hashes = np.concatenate(list(sets.values()))
        who = np.repeat(np.arange(len(fps), dtype=np.int32), [len(s) for s in sets.values()])
        order = np.argsort(hashes, kind="stable")
        hashes, who = hashes[order], who[order]
        cuts = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << np.uint64(HASH_BITS - bits))
        cuts = np.append(cuts, len(hashes))
        rows = []
        for share in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[share], cuts[share + 1]
            there, own = np.unique(who[a:b], return_inverse=True)
            kind = np.uint16 if len(there) < 1 << 16 else np.uint32
            rows.append((share, fps[there].tobytes(), pack(hashes[a:b]), own.astype(kind).tobytes()))
        for i in range(0, len(rows), 64):
            shares, *columns = zip(*rows[i:i + 64])
            yield pa.RecordBatch.from_arrays(
                [pa.array(shares, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]],
                ["share", "sets", "hashes", "who"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for piece in slices(batches):
            for s in shingle_sets(piece.column("text"), SHINGLE):
                if len(s):
                    held[fingerprint(s)] = s >> np.uint64(64 - HASH_BITS)
            size += piece.column("text").nbytes
            if size >= CHUNK_BYTES:
                yield from emit(held)
                held, size = {}, 0
        yield from emit(held)

    return in_batches(docs.select("text"), run, "share int, sets binary, hashes binary, who binary")


def _shared(dealt: DataFrame) -> DataFrame:
    """(fp, shingle, n_sets) of every set's shingles that other sets have too, and how many sets have each."""
    def run(rows: pa.Table) -> pa.Table:
        hashes, fps = [], []
        for s, h, w in zip(*(rows[c].to_pylist() for c in ("sets", "hashes", "who"))):
            numbers = unpack(h)
            there = np.frombuffer(s, np.int64)
            own = np.frombuffer(w, np.uint16 if len(there) < 1 << 16 else np.uint32)
            hashes.append(numbers)
            fps.append(there[own])
        hashes, fps = np.concatenate(hashes), np.concatenate(fps)
        order = np.lexsort((fps, hashes))
        hashes, fps = hashes[order], fps[order]
        new = np.ones(len(hashes), bool)  # equal sets of other chunks are the same set
        new[1:] = (hashes[1:] != hashes[:-1]) | (fps[1:] != fps[:-1])
        hashes, fps = hashes[new], fps[new]
        runs = np.diff(np.append(np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])), len(hashes)))
        count = np.repeat(runs, runs)
        several = count > 1
        hashes, fps, count = hashes[several].astype(np.int64), fps[several], count[several].astype(np.int32)
        order = np.argsort(fps, kind="stable")  # columns with like neighbours take less room
        found = pa.table({"fp": fps[order], "shingle": hashes[order], "n_sets": count[order]})
        del hashes, fps, count, new, runs, several, order
        release_memory()
        return found

    return dealt.groupBy("share").applyInArrow(run, "fp bigint, shingle bigint, n_sets int")


class Joiner:
    """Joins sets that come in the order of their size; knows components, not all links.

    ``index`` has for each shingle the sets with it in their prefix: by size, then by the number of
    elements behind it, then in blocks by component. A set skips by position: two sets that meet
    first at a shingle have no element before it in common, so at most that one and the fewer of
    the elements behind it; whole sizes and whole lists are passed over where that is too little. It
    skips blocks of its own component: the answers of the sets it links with are its answers as far
    as components go. With a set it links with (its leader) it also has the leader's answers: where
    the leader's overlap with a third set is known, overlap(set, third) is at most that plus what
    the set has beyond the leader, and the third is skipped if that is too little.
    """

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.sizes: list[int] = []
        self.items: list[frozenset] = []
        self.root: list[int] = []
        self.failed: list[dict[int, int]] = []  # by set: overlap with sets that it doesn't link with
        self.index: dict[int, dict[int, dict[int, dict[int, list[int]]]]] = {}
        self.latest: dict[int, int] = {}  # by shingle
        self.links: list[tuple[int, int]] = []
        self.compared = self.derived = self.met = 0
        self.known = -1

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def _compare(self, x: int, y: int) -> int:
        """Common elements of two sets; a link joins their components, else the number is kept."""
        self.compared += 1
        common = len(self.items[x] & self.items[y])
        if common >= least_overlap(self.sizes[x], self.sizes[y], self.percent):
            self.links.append((x, y))
            self.root[self.find(x)] = self.find(y)
        else:
            self.failed[y][x] = common
        return common

    def _leader(self, y: int, smallest: int, prefix: list[int]) -> tuple[int, int, set[int]]:
        """(leader or -1, elements beyond it, sets compared): of the latest sets at its shingles that y meets most often."""
        met: dict[int, int] = {}
        for shingle in prefix:
            x = self.latest.get(shingle, -1)
            if x >= 0 and self.sizes[x] >= smallest:
                met[x] = met.get(x, 0) + 1
        if not met:
            return -1, 0, set()
        x = max(met, key=lambda i: (met[i], i))
        if self.find(x) == self.find(y):
            return -1, 0, set()
        common = self._compare(x, y)
        linked = x not in self.failed[y]
        return (x if linked else -1), len(self.items[y]) - common, {x}

    @staticmethod
    def _under_roots(find, blocks: dict[int, list[int]]) -> dict[int, list[int]]:
        """Blocks under their components' present roots."""
        if all(find(r) == r for r in blocks):
            return blocks
        merged: dict[int, list[int]] = {}
        for r, entries in blocks.items():
            merged.setdefault(find(r), []).extend(entries)
        return merged

    def add(self, size: int, ordered: list[int], known: bool = False) -> None:
        """Add a set of ``size`` elements of which ``ordered`` may be shared, rarest first.

        All ``known`` sets are in one component already.
        """
        y = len(self.sizes)
        self.sizes.append(size)
        self.items.append(frozenset(ordered))
        self.root.append(y)
        self.failed.append({})
        if known:
            if self.known >= 0:
                self.root[y] = self.find(self.known)
            self.known = y
        smallest = -(-self.percent * size // 100)
        prefix = ordered[:max(0, len(ordered) - smallest + 1)]
        leader, beyond, tested = self._leader(y, smallest, prefix)
        for place, shingle in enumerate(prefix):
            behind = len(ordered) - place - 1
            for n, lists in reversed(self.index.get(shingle, {}).items()):
                if n < smallest:
                    break  # sizes ascend
                needed = least_overlap(n, size, self.percent)
                if 1 + behind < needed:
                    continue
                for left, blocks in lists.items():
                    if 1 + left < needed:
                        continue
                    blocks = lists[left] = self._under_roots(self.find, blocks)
                    for r, block in blocks.items():
                        if self.find(r) != self.find(y):
                            leader, beyond = self._meet(y, block, needed, leader, beyond, tested)
        mine = self.find(y)
        for place, shingle in enumerate(prefix):
            lists = self.index.setdefault(shingle, {}).setdefault(size, {})
            lists.setdefault(len(ordered) - place - 1, {}).setdefault(mine, []).append(y)
            self.latest[shingle] = y

    def _meet(self, y: int, block: list[int], needed: int, leader: int, beyond: int,
              tested: set[int]) -> tuple[int, int]:
        """Compare y with the sets of a block until one links; returns its leader and what it has beyond it."""
        for x in reversed(block):
            self.met += 1
            if x in tested:
                continue
            tested.add(x)
            if leader >= 0:
                known = self.failed[leader].get(x, self.failed[x].get(leader))
                if known is not None and known + beyond < needed:
                    self.derived += 1
                    continue
            common = self._compare(x, y)
            if common >= needed:
                return (leader, beyond) if leader >= 0 else (x, len(self.items[y]) - common)
        return leader, beyond


def _join_pieces(cells: DataFrame) -> DataFrame:
    """Verified links (a, b) that connect what is connected, for rows sorted by cell and size."""
    def finish(rows: list[tuple[int, int, list[int], bool]]) -> Iterator[pa.RecordBatch]:
        joiner = Joiner()
        ids = [r[0] for r in rows]
        for _, size, ordered, known in rows:
            joiner.add(size, ordered, known)
        if joiner.links:
            a, b = zip(*joiner.links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in a], pa.int64()), pa.array([ids[i] for i in b], pa.int64())],
                ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, current = [], None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                columns = [piece.column(c).to_pylist() for c in ("cell", "fp", "n_shingles", "ordered", "known")]
                for cell, *row in zip(*columns):
                    if cell != current:
                        yield from finish(held)
                        held, current = [], cell
                    held.append(row)
        yield from finish(held)

    return in_batches(cells, run, "a bigint, b bigint")


def cluster(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document, by whole texts.

    A document's set: its distinct runs of five words (A-Z lower-cased; all words if fewer), empty
    for null and wordless texts. Documents link if 100 * intersection >= 75 * union; empty sets
    link with nothing. component_id is the smallest doc_id reachable by links, itself included.
    Rows stay as they are: repeated ones are one document; rows with one doc_id and several texts
    connect what each of them links with; a row without doc_id links with nothing and has a null
    component_id. An empty table gives an empty table. Sets are compared by 48-bit hashes.

    Equal sets are one. Shingles are dealt out by hash, packed and counted by chunk beforehand; a
    shingle that only one set has can't be common, so a set with fewer than 75 % shared shingles
    links with nothing and no more is read of it. The others are joined by prefixes of their rarest
    shared shingles: sets with a common prefix shingle form groups. A small group is joined in one
    piece. Of a large one every set is compared with its leader first; those that link with it need
    no comparison among each other, and what is left is joined block by block in pieces that hold
    any two sets together of which one does not link with the leader. No pair is written but links
    that connect a group.
    """
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), "text")
    listed = written(fingerprints(rows), "set-join")
    named = listed.filter(F.col("doc_id").isNotNull() & F.col("fp").isNotNull())
    classes = named.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"))
    bits = min(24, (parts(text_bytes(rows), SHARE_BYTES) - 1).bit_length())
    shared = written(_shared(_deal(rows.filter("doc_id is not null"), bits)), "set-join-shared")
    enough = shared.groupBy("fp").agg(F.count(F.lit(1)).alias("n_shared")).join(classes, "fp").filter(
        F.col("n_shared") * 100 >= F.col("n_shingles") * PERCENT).select("fp", "n_shingles")
    rarest_first = F.array_sort(F.collect_list(F.struct("n_sets", "shingle")))  # of one text
    candidates = written(
        shared.join(enough, "fp").groupBy("fp", "n_shingles").agg(rarest_first["shingle"].alias("ordered")),
        "set-join-sets")
    links = _links(candidates)
    names = classes.select("fp", "rep")
    edges = links.join(names.withColumnsRenamed({"fp": "a", "rep": "ra"}), "a").join(
        names.withColumnsRenamed({"fp": "b", "rep": "rb"}), "b").select(
        F.col("ra").alias("a"), F.col("rb").alias("b"))
    several = named.groupBy("doc_id").agg(F.min("fp").alias("x"), F.max("fp").alias("y")).filter("x != y")
    same_id = named.join(several.select("doc_id"), "doc_id").join(names, "fp").select(
        F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    roots = components(edges.union(same_id))
    of_class = names.join(roots, names["rep"] == roots["node"], "left").select(
        F.col("fp").alias("own"), F.coalesce("root", "rep").alias("root"))
    joined = listed.join(of_class, (listed["fp"] == of_class["own"]) & listed["doc_id"].isNotNull(), "left")
    return joined.select("doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id"))


def _links(candidates: DataFrame) -> DataFrame:
    needed: Column = F.ceil(F.col("n_shingles") * PERCENT / 100).cast("int")
    prefix = F.slice("ordered", F.lit(1), F.greatest(F.lit(0), F.size("ordered") - needed + 1))
    postings = candidates.select("fp", F.explode(prefix).alias("shingle"))
    pivots = postings.groupBy("shingle").agg(F.min("fp").alias("pivot"))
    near = components(postings.join(pivots, "shingle").filter("fp != pivot").select(
        F.col("fp").alias("a"), F.col("pivot").alias("b")).distinct())
    grouped = materialize(candidates.select("fp", F.size("ordered").alias("size")).join(
        near, F.col("fp") == F.col("node")).select("fp", F.col("root").alias("grp"), "size"))
    leaders = materialize(grouped.groupBy("grp").agg(
        F.sum("size").alias("total"), F.min_by("fp", F.xxhash64("fp")).alias("leader")).filter(
        F.col("total") > LED_SHINGLES).select("grp", "leader"))
    small = grouped.join(leaders, "grp", "left_anti").select("fp", F.xxhash64("grp").alias("cell"), F.lit(False).alias("known"))
    led = _led(candidates, grouped, leaders)
    cells = small.union(_led_cells(led))
    pieces = _join_pieces(
        cells.join(candidates, "fp").select("cell", "fp", "n_shingles", "ordered", "known")
        .repartition("cell").sortWithinPartitions("cell", "n_shingles", "fp"))
    return materialize(pieces.union(led.filter("known and fp != leader").select(
        F.col("fp").alias("a"), F.col("leader").alias("b"))))


def _led(candidates: DataFrame, grouped: DataFrame, leaders: DataFrame) -> DataFrame:
    """fp, grp, size, leader and known (links with the leader) of the sets of large groups."""
    heads = leaders.join(candidates, F.col("leader") == F.col("fp")).select(
        "grp", F.col("n_shingles").alias("n_head"), F.col("ordered").alias("head"))
    sets = grouped.join(leaders, "grp").join(candidates.select("fp", "n_shingles", "ordered"), "fp").join(heads, "grp")
    common = F.size(F.array_intersect("ordered", "head"))
    known = 100 * common >= PERCENT * (F.col("n_shingles") + F.col("n_head") - common)
    return materialize(sets.select("fp", "grp", "size", "leader", known.alias("known")))


def _led_cells(led: DataFrame) -> DataFrame:
    """fp, cell and known of large groups: cells in which any two sets meet that are not both known.

    Known sets are connected already. They are dealt into blocks of LED_SHINGLES, each with every block
    of the others; of those any two blocks meet in a cell of their own.
    """
    size = lambda of: F.sum(F.when(of, F.col("size")).otherwise(0))
    blocks = led.groupBy("grp").agg(
        F.ceil(size(F.col("known")) / LED_SHINGLES).alias("known_blocks"),
        F.ceil(size(~F.col("known")) / PIECE_SHINGLES).alias("other_blocks")).filter("other_blocks > 0")
    rows = led.join(blocks, "grp")
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("fp"), F.col(n))
    known = rows.filter("known").select("fp", "known", "grp", own("known_blocks").alias("i"), upto("other_blocks").alias("j"))
    others = rows.filter("not known").withColumn("j", own("other_blocks"))
    mixed = known.union(others.select("fp", "known", "grp", upto("known_blocks").alias("i"), "j"))
    apart = others.filter("other_blocks > 1").withColumn("i", upto("other_blocks")).filter("i != j")
    return mixed.select("fp", F.xxhash64("grp", F.lit("known"), "i", "j").alias("cell"), "known").union(
        apart.select("fp", F.xxhash64("grp", F.lit("others"), F.least("i", "j"), F.greatest("i", "j")).alias("cell"), "known"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the first row.

    Rows are told apart by their place, not by doc_id: repeated rows are copies, rows with one doc_id
    and unlike texts both stay, rows without doc_id take part. Rows with an empty set all stay.
    ``docs`` is read several times and must come in the same order, as a table of files does.
    """
    places = [f"_{i}" for i in range(len(docs.columns))]
    text = places[docs.columns.index("text")]
    rows = docs.toDF(*places).withColumn("row", F.monotonically_increasing_id())
    found = cluster(rows.select(F.col("row").alias("doc_id"), F.col(text).alias("text")))
    gone = found.filter("component_id != doc_id").select(F.col("doc_id").alias("row"))
    return rows.join(gone, "row", "left_anti").select(*places).toDF(*docs.columns)


#: Documents that share a shingle are compared, over whole texts. Ids are taken to be unique, as in the given tables.
OP8_SQL = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
        ELSE array_to_string(list_slice(w, i, i + 4), ' ') END AS s
    FROM (SELECT doc_id, w, UNNEST(range(1, GREATEST(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n FROM shingles a JOIN shingles b
    ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
pairs AS (
    SELECT a, b FROM shared JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
    WHERE 100 * shared.n >= {PERCENT} * (x.n + y.n - shared.n)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
    SELECT DISTINCT a AS node, a AS other FROM links
    UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
roots AS (SELECT node, MIN(other) AS root FROM reach GROUP BY node)
SELECT d.doc_id, CAST(COALESCE(s.n, 0) AS BIGINT) AS n_shingles,
    CAST(COALESCE(r.root, d.doc_id) AS BIGINT) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN roots r ON d.doc_id = r.node
"""


def op8_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/documents.parquet"))
