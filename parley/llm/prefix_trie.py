"""Which conversations begin alike: adaptive radix trees over fixed-width big-endian turn ids."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.llm.common import bounded, stored
from parley.operators.ordered import ordered, position_block

#: Bytes of a turn id: the first of the SHA-256 of its role and text, read as a big-endian number.
WIDTH = 16
#: Turns of a conversation in one key; what follows is a key of the next level.
BLOCK = 512
#: Keys that one task builds trees of.
KEYS = 4096
#: Conversations that share their beginning by construction, and the most turns they share.
FAMILY, SHARED = 5, 8
#: Characters of ids that are hashed at a time.
CHUNK = 1 << 20
NODE, ENTRY, TOTAL = 0, 1, 2


class Inner:
    """An inner node: `path` are the bytes from its parent (path compression), `value` the key that ends here.

    The layout grows with the children: up to 4 and up to 16 sorted bytes beside their children, up to 48 children
    behind an index of all bytes, or a child slot for every byte.
    """

    __slots__ = ("path", "value", "room", "keys", "kids", "used")

    def __init__(self, path: bytes) -> None:
        self.path, self.value, self.room, self.keys, self.kids, self.used = path, None, 4, bytearray(), [], 0

    def find(self, byte: int):
        if self.room <= 16:
            at = bisect_left(self.keys, byte)
            return self.kids[at] if at < self.used and self.keys[at] == byte else None
        if self.room == 48:
            return self.kids[self.keys[byte] - 1] if self.keys[byte] else None
        return self.kids[byte]

    def put(self, byte: int, kid) -> None:
        """Add a child, or set it anew."""
        if self.find(byte) is None:
            if self.used == self.room:
                self._grow()
            self.used += 1
            if self.room <= 16:
                at = bisect_left(self.keys, byte)
                self.keys.insert(at, byte)
                self.kids.insert(at, kid)
            elif self.room == 48:
                self.kids.append(kid)
                self.keys[byte] = self.used
            else:
                self.kids[byte] = kid
        elif self.room <= 16:
            self.kids[bisect_left(self.keys, byte)] = kid
        elif self.room == 48:
            self.kids[self.keys[byte] - 1] = kid
        else:
            self.kids[byte] = kid

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray(256)
            for i, byte in enumerate(self.keys):
                index[byte] = i + 1
            self.room, self.keys = 48, index
        else:
            self.room, self.kids, self.keys = 256, [self.kids[at - 1] if at else None for at in self.keys], bytearray()

    def children(self) -> list:
        """In the order of their bytes."""
        if self.room <= 16:
            return list(self.kids)
        if self.room == 48:
            return [self.kids[at - 1] for at in self.keys if at]
        return [kid for kid in self.kids if kid is not None]


class Leaf:
    """The one key below a byte: the rest of it is not spelled out in nodes."""

    __slots__ = ("path", "value")

    def __init__(self, path: bytes, value: int) -> None:
        self.path, self.value = path, value


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


def insert(root: Inner, key: bytes, value: int) -> None:
    """Add a key that is not in the tree yet."""
    node, rest = root, key
    while rest:
        kid = node.find(rest[0])
        if kid is None:
            node.put(rest[0], Leaf(rest, value))
            return
        same = _common(kid.path, rest)
        if same < len(kid.path) or isinstance(kid, Leaf):  # the way splits here, or goes on below a leaf
            fork = Inner(rest[:same])
            kid_rest = kid.path[same:]
            if kid_rest:
                kid.path = kid_rest
                fork.put(kid_rest[0], kid)
            else:
                fork.value = kid.value
            node.put(rest[0], fork)
            kid = fork
        node, rest = kid, rest[same:]
    node.value = value


def _least(a: int | None, b: int | None) -> int | None:
    """The smaller one; a node whose members all lie in other tasks has none here."""
    return b if a is None else a if b is None else min(a, b)


class Below:
    """What lies below a place of the tree: the topmost turn nodes (rows of the output) and their sums."""

    __slots__ = ("tops", "n", "conv", "leaves", "saved", "first", "last")

    def __init__(self) -> None:
        self.tops: list[list] = []
        self.n, self.leaves, self.saved = 0, 0, 0
        self.conv = self.first = self.last = None

    def add(self, other: Below) -> None:
        self.tops = other.tops if not self.tops else self.tops + other.tops
        self.n, self.leaves, self.saved = self.n + other.n, self.leaves + other.leaves, self.saved + other.saved
        self.conv = _least(self.conv, other.conv)
        self.first, self.last = other.first if self.first is None else self.first, other.last


def name_of(start: bytes, prefix: bytes) -> bytes:
    """Names the node that `prefix` leads to from the node named `start`."""
    return hashlib.sha256(start + prefix).digest()[:WIDTH] if prefix else start


class Trie:
    """The turn nodes of the keys that begin below one node.

    An entry is (key, bytes of each turn, n, conv, children, leaves, saved, ends, more): what ends at the key or hangs
    below it outside this tree. `left` or `right` says that the first or the last key may have neighbours in other
    tasks; the nodes along it are not finished here but handed on as entries.
    """

    def __init__(self, level: int, start: bytes, entries: list[tuple], left: bool, right: bool, named: bool, block: int) -> None:
        self.level, self.start, self.left, self.right, self.named, self.block = level, start, left, right, named, block
        self.out: list[list] = []
        self.root = Inner(b"")
        own = []
        for e in entries:  # sorted; entries of one key are taken together
            if own and own[-1][0] == e[0]:
                old = own[-1]
                own[-1] = (*old[:2], old[2] + e[2], _least(old[3], e[3]),
                           old[4] + e[4], old[5] + e[5], old[6] + e[6], old[7] or e[7], old[8] or e[8])
            else:
                own.append(e)
        self.entries = own
        for i, e in enumerate(own):
            insert(self.root, e[0], i)

    def rows(self) -> list[list]:
        """Rows (kind, level, start, key, sizes, depth, conv, parent, up, name, n, children, leaves, saved, ends, more)."""
        todo: list[tuple] = [(self.root, 0, None)]
        done: dict[int, Below] = {}
        while todo:  # children before their parents, without recursion
            node, upto, state = todo.pop()
            end = upto + len(node.path)
            kids = node.children() if isinstance(node, Inner) else []
            if state is None and kids:
                todo.append((node, upto, True))
                todo += [(kid, end, None) for kid in reversed(kids)]
                continue
            below = Below()
            for kid in kids:
                below.add(done.pop(id(kid)))
            value = node.value
            if value is not None:
                below.first = value
                below.last = value if below.last is None else below.last
            key, sizes = self.entries[below.first][:2] if below.first is not None else (b"", [])
            for at in range(end - end % WIDTH, upto, -WIDTH):
                below = self._turn(below, key[:at], sizes[:at // WIDTH], self.entries[value] if value is not None and at == end else None)
            if node is self.root:
                self._top(below, self.entries[value] if value is not None else None)
            done[id(node)] = below
        return self.out

    def _summed(self, below: Below, own: tuple | None) -> tuple[int, int | None, int, int, int, str | None, bool]:
        n, conv, children, leaves, saved = below.n, below.conv, len(below.tops), below.leaves, below.saved
        if own is None:
            return n, conv, children, leaves, saved, None, False
        return n + own[2], _least(conv, own[3]), children + own[4], leaves + own[5], saved + own[6], own[7], own[8]

    def _spine(self, below: Below) -> bool:
        return self.left and below.first == 0 or self.right and below.last == len(self.entries) - 1

    def _handed_on(self, below: Below, prefix: bytes, sizes: list[int], own: tuple | None) -> None:
        finished = [top for top in below.tops if top[0] == NODE]
        for top in finished:
            top[8] = name_of(self.start, prefix)
        n, conv = sum(t[10] for t in finished), min((t[6] for t in finished), default=None)
        children, leaves, saved, ends, more = len(finished), sum(t[12] for t in finished), sum(t[13] for t in finished), None, False
        if own is not None:
            n, children, leaves, saved, ends, more = n + own[2], children + own[4], leaves + own[5], saved + own[6], own[7], own[8]
            conv = _least(conv, own[3])
        self.out.append([ENTRY, self.level, self.start, prefix, sizes, 0, conv, None, None, None, n, children, leaves, saved, ends, more])

    def _turn(self, below: Below, prefix: bytes, sizes: list[int], own: tuple | None) -> Below:
        up = Below()
        up.first, up.last = below.first, below.last
        n, conv, children, leaves, saved, ends, more = self._summed(below, own)
        if self._spine(below):
            self._handed_on(below, prefix, sizes, own)
            row = self.out[-1]
            up.n, up.conv = n, conv
        else:
            for top in below.tops:
                top[7] = conv
            leaves, saved = (leaves if children else 1), saved + (n - 1) * sizes[-1]
            row = [NODE, self.level, None, None, None, self.level * self.block + len(sizes), conv, None, None,
                   name_of(self.start, prefix) if self.named or more else None, n, children, leaves, saved, ends, False]
            self.out.append(row)
            up.n, up.conv, up.leaves, up.saved = n, conv, leaves, saved
        up.tops = [row]
        return up

    def _top(self, below: Below, own: tuple | None) -> None:
        """The node that all keys begin below: a turn node only if it is the root of all."""
        if self.left or self.right:
            self._handed_on(below, b"", [], own)
            return
        n, conv, children, leaves, saved, ends, _ = self._summed(below, own)
        if self.level:
            for top in below.tops:
                top[8] = self.start
            self.out.append([TOTAL, self.level, self.start, None, None, 0, conv, None, None, None, n, children, leaves, saved, None, False])
        else:
            for top in below.tops:
                top[7] = conv
            self.out.append([NODE, 0, None, None, None, 0, conv, None, None, self.start if self.named else None, n, children, leaves if children else 1, saved, ends, False])


OUT = {"kind": pa.int32(), "level": pa.int64(), "start": pa.binary(), "key": pa.binary(), "sizes": pa.list_(pa.int64()), "depth": pa.int64(),
       "conv": pa.int64(), "parent": pa.int64(), "up": pa.binary(), "name": pa.binary(), "n": pa.int64(), "children": pa.int64(),
       "leaves": pa.int64(), "saved": pa.int64(), "ends": pa.string(), "more": pa.bool_()}
ENTRIES = ("level", "start", "key", "sizes", "n", "conv", "children", "leaves", "saved", "ends", "more")
_DDL = "kind int, level long, start binary, key binary, sizes array<long>, depth long, conv long, parent long, up binary, name binary, " \
       "n long, children long, leaves long, saved long, ends string, more boolean"


def _trees(entries: DataFrame, parts: int, named: bool, block: int) -> DataFrame:
    """Trees of all entries in `parts` ranges of their keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        of, first = None, True

        def told(last: bool) -> Iterator[pa.RecordBatch]:
            rows = Trie(*of, held, parts > 1 and first, parts > 1 and last, named, block).rows()
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*rows), OUT.values())], list(OUT))

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ENTRIES)):
                if of is not None and row[:2] != of:
                    yield from told(False)
                    held, first = [], False
                of = row[:2]
                held.append(row[2:])
        if of is not None:
            yield from told(True)

    dealt = entries.select(*ENTRIES)
    dealt = dealt.coalesce(1) if parts == 1 else dealt.repartitionByRange(parts, "level", "start", "key")
    return dealt.sortWithinPartitions("level", "start", "key").mapInArrow(run, _DDL)


def _level(entries: DataFrame, keys: int, block: int) -> list[DataFrame]:
    """Finished rows of the tries of one level. What is unfinished at the edges of a task's range, a path for each edge,
    becomes the entries of the next pass, until they fit in one task. A path has at most block + 1 nodes, so tasks of
    twice as many keys as two paths have halve the entries at least."""
    out, named = [], False
    while True:
        entries = stored(entries, "entries")
        parts = -(-entries.count() // keys)
        if not parts:
            return out
        built = stored(_trees(entries, parts, named, block), "trie")
        out.append(built.where(F.col("kind") != ENTRY))
        if parts == 1:
            return out
        entries, named, keys = built.where(F.col("kind") == ENTRY).select(*ENTRIES), True, max(keys, 4 * (block + 1))


def _short(column: Column) -> Column:
    """The first `WIDTH` bytes of the SHA-256, in hex."""
    return F.substring(F.sha2(column, 256), 1, 2 * WIDTH)


def _rebuilt(turns: DataFrame, hot: bool | None) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns `conv`, `pos` from 0, `id` (hex), `size`; and conversations `conv` with their `length`."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where("conv is not null").select("conv", "turn", _short(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)).alias("id"),
                                                  F.octet_length(text).cast("long").alias("size"))
    own = stored(ordered(rows, ["conv"], ["turn", "id"], position_block("turn"), hot).number("k").rows().select("conv", "k", "id", "size"), "turns")
    base = own.where((F.col("conv") % FAMILY == 0) & (F.col("k") <= SHARED))
    has = base.groupBy(F.col("conv").alias("base")).agg(F.max("k").alias("has"))
    convs = own.groupBy("conv").agg(F.max("k").alias("n")).withColumn("base", F.col("conv") - F.col("conv") % FAMILY)
    convs = convs.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % (SHARED + 1)).join(has, "base", "left")
    convs = stored(convs.withColumn("taken", F.least("h", F.coalesce("has", F.lit(0)))), "conversations")
    rest = own.join(convs, "conv").where("k > h").select("conv", (F.col("k") - 1 - F.col("h") + F.col("taken")).alias("pos"), "id", "size")
    begin = base.withColumnRenamed("conv", "base").join(convs.select("conv", "base", "h"), "base").where("k <= h")
    turns = begin.select("conv", (F.col("k") - 1).alias("pos"), "id", "size").unionByName(rest)
    return turns, convs.select("conv", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def _chained(blocks: DataFrame) -> DataFrame:
    """Blocks of long conversations with `start`, the name of the node each begins at; they stream in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, name = None, b""
        for batch in batches:
            starts = []
            for own, key in zip(batch.column("conv").to_pylist(), batch.column("key").to_pylist()):
                name = name if own == conv else b""
                starts.append(name)
                conv, name = own, name_of(name, key)
            yield batch.append_column("start", pa.array(starts, pa.binary()))

    return blocks.repartition("conv").sortWithinPartitions("conv", "level").mapInArrow(run, blocks.schema.simpleString()[7:-1].replace(":", " ") + ", start binary")


def _ends(members: DataFrame) -> DataFrame:
    """`name` and the SHA-256 of the joined ids of the conversations `conv` that end there.

    Ranges of the sorted ids are joined to texts first, so even a node where a third of all end is hashed from few rows,
    which one task streams in order.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, held, size = None, 0, [], 0
        for batch in batches:
            out = []
            for own, conv in zip(batch.column("name").to_pylist(), batch.column("conv").to_pylist()):
                if held and (own != name or size > CHUNK):
                    out.append((name, first, ",".join(held)))
                    held, size = [], 0
                if not held:
                    name, first = own, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield chunk(out)
        if held:
            yield chunk([(name, first, ",".join(held))])

    def chunk(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out), (pa.binary(), pa.int64(), pa.string()))], ["name", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, out = None, None, []
        for batch in batches:
            out = []
            for own, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
                if state is not None and own == name:
                    state.update(b",")
                else:
                    out += [(name, state.hexdigest())] if state is not None else []
                    name, state = own, hashlib.sha256()
                state.update(ids.encode())
            if out:
                yield told(out)
        if state is not None:
            yield told([(name, state.hexdigest())])

    def told(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out), (pa.binary(), pa.string()))], ["name", "sha"])

    chunks = members.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv").mapInArrow(joined, "name binary, first long, ids string")
    return chunks.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "name binary, sha string")


def _name(start: str, key: str) -> Column:
    return F.when(F.octet_length(key) == 0, F.col(start)).otherwise(F.unhex(_short(F.concat(F.col(start), F.col(key)))))


def _alone(blocks: DataFrame, block: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of blocks beyond the first of their conversation: the nodes and the totals of beginnings that only equal
    conversations go on from, which need no tree, and the blocks of the others."""
    whole = blocks.groupBy("conv").agg(F.max_by("name", "level").alias("whole"))
    blocks = stored(blocks.where("level > 0").join(whole, "conv"), "later")
    lone = (blocks.groupBy("start").agg(F.min("conv").alias("first"), F.count("*").alias("n"), F.min("whole").alias("a"), F.max("whole").alias("b"))
            .where("a = b").select(F.col("start").alias("own"), "first", "n"))
    lone = stored(lone, "alone")
    shared = blocks.join(lone, F.col("start") == F.col("own"), "left_anti").drop("whole")
    later = Window.partitionBy("conv").orderBy(F.desc("level"))
    size = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    own = (blocks.join(lone, (F.col("start") == F.col("own")) & (F.col("conv") == F.col("first"))).withColumn("size", size)
           .withColumn("rest", F.coalesce(F.sum("size").over(later.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("top", F.min("level").over(Window.partitionBy("conv")) == F.col("level")))
    own = stored(own, "chains")
    totals = own.where("top").select("start", F.lit(1).cast("long").alias("children"), F.lit(1).cast("long").alias("leaves"),
                                     ((F.col("n") - 1) * (F.col("size") + F.col("rest"))).alias("saved"))
    each = own.select("*", F.posexplode("sizes").alias("i", "bytes"))
    along = Window.partitionBy("conv", "level").orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    last = (F.col("i") == F.size("sizes") - 1) & F.col("done")
    begins = F.col("top") & (F.col("i") == 0)
    nodes = each.select((F.col("level") * block + F.col("i") + 1).alias("depth"), "conv", F.when(~begins, F.col("conv")).alias("parent"),
                        F.when(begins, F.col("start")).alias("up"), F.lit(None).cast("binary").alias("name"), "n", F.when(last, 0).otherwise(1).cast("long").alias("children"),
                        F.lit(1).cast("long").alias("leaves"), ((F.col("n") - 1) * (F.sum("bytes").over(along) + F.col("rest"))).alias("saved"),
                        F.when(last, F.col("ends")).alias("ends"))
    return nodes, totals, shared


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", hot: bool | None = None, block: int = BLOCK, keys: int = KEYS) -> DataFrame:
    """The trie of all rebuilt conversations, a row for each node: `conv_id`, `depth`, `parent_conv_id`, `n_convs`,
    `n_children`, `n_leaves`, `saved_tokens`, `ends_sha256`.

    Conversation c begins with the first h turns of conversation c - c % 5 and goes on with its own turns after its
    first h; h is crc32 of the decimal c modulo 9. A turn is a fixed-width big-endian id, the first 16 bytes of the SHA-256
    of role and text, and a conversation a key of such ids. Equal keys are merged, the rest is dealt out by ranges
    of keys; each task builds an adaptive radix tree of its range, and only byte depths between whole ids
    are nodes. Nodes along the two edges of a range may go on in the next task: they are handed on, with what hangs
    off them summed, to another pass over these few paths, so a first turn that a third of all share is no single task.
    A key holds `block` turns, and a task builds trees of `keys` keys; what follows is a key of another tree, named by its way from the root, and sums are
    carried up level by level. Where only equal conversations go on, no tree is needed and none is built.

    Turns are ordered by `turn`, null first, equal ones by id. Null role or text is empty. Rows without a conversation
    id belong to no conversation and are left out. Repeated rows are turns of their own. A conversation without
    a rebuilt turn ends at the root. An empty table has no conversations and no nodes. Further columns are ignored.
    """
    turns = turns.select(F.col(conv_col).cast("long").alias("conv"), "turn", "role", "text")
    rebuilt, convs = _rebuilt(turns, hot)
    blocks = rebuilt.groupBy("conv", F.floor(F.col("pos") / block).cast("long").alias("level")).agg(F.array_sort(F.collect_list(F.struct("pos", "id", "size"))).alias("own"))
    blocks = blocks.select("conv", "level", F.unhex(F.array_join("own.id", "")).alias("key"), F.col("own.size").alias("sizes"))
    empty = convs.where("length = 0").select("conv", F.lit(0).cast("long").alias("level"), F.unhex(F.lit("")).alias("key"), F.array().cast("array<bigint>").alias("sizes"))
    blocks = stored(blocks.unionByName(empty), "blocks")
    levels = (blocks.agg(F.max("level").alias("most")).first().most or 0) + 1
    last = F.floor((F.greatest(F.col("length"), F.lit(1)) - 1) / block) == F.col("level")
    if levels == 1:
        blocks = blocks.withColumns({"start": F.unhex(F.lit("")), "done": F.lit(True)})
    else:
        long = stored(blocks.where("level > 0").select("conv").distinct(), "long")
        chained = _chained(blocks.join(long, "conv"))
        blocks = blocks.join(long, "conv", "left_anti").withColumn("start", F.unhex(F.lit(""))).unionByName(chained)
        blocks = blocks.join(convs, "conv").withColumn("done", last).drop("length")
    blocks = blocks.withColumn("name", _name("start", "key"))
    blocks = blocks if levels == 1 else stored(blocks, "named")
    merged = blocks.groupBy("level", "start", "key", "name", "done").agg(F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("sizes").alias("sizes"))
    merged = stored(merged, "merged")
    several = stored(merged.where("done and n > 1").select("name"), "several")
    members = blocks.where("done").join(bounded(several), "name").select("name", "conv")
    ends = stored(_ends(members), "ends")
    ended = F.when(F.col("done"), F.coalesce("sha", F.sha2(F.col("conv").cast("string"), 256)))
    merged = merged.join(bounded(ends), "name", "left").withColumn("ends", ended).drop("sha")
    out: list[DataFrame] = []
    node = ("depth", "conv", "parent", "up", "name", "n", "children", "leaves", "saved", "ends")
    totals, shared = None, None
    if levels > 1:
        done = blocks.join(bounded(ends), "name", "left").withColumn("ends", ended).drop("sha")
        nodes, totals, shared = _alone(done, block)
        out.append(nodes.select(*node))
        shared = stored(shared.groupBy("level", "start", "key", "name", "done").agg(F.count("*").alias("n"), F.min("conv").alias("conv"),
                                                                                     F.first("sizes").alias("sizes"), F.first("ends").alias("ends")), "shared")
        totals = stored(totals, "totals")
        levels = (shared.agg(F.max("level").alias("most")).first().most or 0) + 1
    for level in reversed(range(levels)):
        entries = merged.where("level = 0") if level == 0 else shared.where(F.col("level") == level)
        entries = entries.withColumn("more", ~F.col("done"))
        if totals is None:
            entries = entries.withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")})
        else:
            entries = entries.join(totals.withColumnRenamed("start", "name"), "name", "left").fillna(0, ["children", "leaves", "saved"])
            entries = entries.withColumns({c: F.when(F.col("done"), 0).otherwise(F.col(c)).cast("long") for c in ("children", "leaves", "saved")})
        built = _level(entries, keys, block)
        out += [b.where(F.col("kind") == NODE).select(*node) for b in built]
        if level:
            for b in built:
                totals = totals.unionByName(b.where(F.col("kind") == TOTAL).select("start", "children", "leaves", "saved"))
    if not out:
        out = [stored(_trees(merged.withColumns({"more": F.lit(False), **{c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")}}), 1, False, block), "trie").select(*node)]
    nodes = out[0]
    for other in out[1:]:
        nodes = nodes.unionByName(other)
    named = stored(nodes.where("name is not null").select(F.col("name").alias("up"), F.col("conv").alias("above")), "named")
    nodes = nodes.join(bounded(named), "up", "left")
    return nodes.select(F.col("conv").alias(conv_col), "depth", F.coalesce("parent", "above").alias(f"parent_{conv_col}"), F.col("n").alias("n_convs"),
                        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
