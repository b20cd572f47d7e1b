"""Source divergence audit: how do the terms of each source differ from those of the other sources of its language?

Which terms are frequent enough to compare is found by iceberg prefix refinement. Terms are extended by byte prefixes, level
by level: a level counts, for each prefix of its length, the documents that have a term with it, and discards the prefixes
below the threshold; the next level looks only at terms whose prefix is left. A term shorter than the level's length is
complete, and its count is its own; complete terms over the threshold are kept. No term in fewer documents than the
threshold can be lost or kept wrongly, as every prefix of a term is in at least as many documents as the term.

Each level is one pass over the texts. A task adds up what it has read before it hands it on. Which prefixes are left it
sees in a bitmap of ``BITS`` hashed prefixes, whose size does not depend on the input; a prefix that only shares a bit with
one that is left is discarded by a join with the level before. A last pass counts the uses of the kept terms in each source,
by 64-bit hashes, behind a bitmap and a join of the same kind.

Term counts are then compared in cells: a block of terms and two tiles of sources, as dense integer arrays of bounded size.
Sources without a term in a block take part with their least probability, so that every kept term counts for every pair.
Probabilities are whole numbers, in parts of ``SCALE``, and all arithmetic on them is exact.

Defined cases: null text, language and source count as empty ones; a document without terms still makes its group occur; a
row is a document, repeated rows are several; a language without kept terms has pairs of value 0; an empty table gives an
empty result. Terms with equal values are ranked by their bytes. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from ..session import write_once
from .batches import LOWER, Texts, Words, byte_class, mix, range_hashes, slices, tidy

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SMOOTH = 2
#: Length in bytes of the first level's prefixes; it doubles from level to level.
FIRST_LENGTH = 6
#: Bits that say which prefixes are left; more of them only mean fewer candidates that the join discards.
BITS = 1 << 24
#: Candidates that a task adds up before it hands them on.
HELD = 400_000
#: Terms and sources of a cell.
BLOCK_TERMS, TILE = 1024, 128

#: ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``
LETTERS = byte_class(bytes([*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_BITMAP_BITS = 32_768  # of one of Spark's bitmaps

_CANDIDATES = StructType([StructField("lang", StringType()), StructField("term", BinaryType()), StructField("docs", LongType())])


def _keys(hashes: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """A hash of term and language; the language may be spelled like the term."""
    return mix(hashes + mix(lang + np.uint64(1)))


def _bit(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys % np.uint64(bits)).astype(np.int64)


def _name_hashes(names: pa.Array) -> np.ndarray:
    texts = Texts.of(names)
    return range_hashes(texts.data, texts.bounds[:-1], texts.bounds[1:])


class _Slice:
    """Terms of a slice, lower-cased, with hashes of the language and source of their document."""

    def __init__(self, batch: pa.RecordBatch, least: int):
        self.texts = Texts.of(batch["text"])
        self.texts.data = LOWER[self.texts.data]
        words = Words.of(self.texts, LETTERS)
        wide = words.ends - words.starts >= least
        self.starts, self.ends, self.doc = words.starts[wide], words.ends[wide], words.text_of[wide]
        self.langs = batch["lang"].dictionary_encode()
        self.lang_of = self.langs.indices.to_numpy(zero_copy_only=False)
        self.lang_hash = _name_hashes(self.langs.dictionary)[self.lang_of]

    def prefixes(self, length: int | None = None) -> np.ndarray:
        """Key of the first bytes of each term."""
        ends = self.ends if length is None else np.minimum(self.ends, self.starts + length)
        return _keys(range_hashes(self.texts.data, self.starts, ends), self.lang_hash[self.doc])

    def keep(self, which: np.ndarray) -> None:
        self.starts, self.ends, self.doc = self.starts[which], self.ends[which], self.doc[which]


def _level(docs: DataFrame, shorter: int, length: int, left: np.ndarray | None, bits: int) -> DataFrame:
    """Candidates of a level with their documents, added up by task: prefixes of ``length`` bytes, and complete terms of
    ``shorter`` to ``length - 1`` bytes. ``left``: bits of the prefixes left at ``shorter``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], []]  # keys, documents
        rows: dict[int, tuple[str, bytes]] = {}
        waiting = 0

        def add_up() -> list[np.ndarray]:
            key, place = np.unique(np.concatenate(held[0]), return_inverse=True)
            return [key, np.bincount(place, np.concatenate(held[1])).astype(np.int64)]

        def send() -> pa.RecordBatch:
            key, docs = add_up()
            found = [rows[k] for k in key.tolist()]
            columns = [pa.array([r[i] for r in found], kind) for i, kind in enumerate((pa.string(), pa.binary()))]
            held[0], held[1] = [], []
            rows.clear()
            return pa.RecordBatch.from_arrays([*columns, pa.array(docs)], names=_CANDIDATES.fieldNames())

        for batch in batches:
            for piece in slices(batch, "text"):
                terms = _Slice(piece, shorter)
                if left is not None and len(terms.starts):
                    terms.keep(left[_bit(terms.prefixes(shorter), bits)])
                if not len(terms.starts):
                    continue
                # Once for each document, then added up over the slice.
                key = terms.prefixes(length)
                first = np.unique(key + mix(terms.doc.astype(np.uint64) + np.uint64(7)), return_index=True)[1]
                own, at, docs = np.unique(key[first], return_index=True, return_counts=True)
                held[0].append(own)
                held[1].append(docs)
                data, names = terms.texts.data.tobytes(), terms.langs.dictionary.to_pylist()
                where = first[at]
                begins, ends = terms.starts[where], np.minimum(terms.ends[where], terms.starts[where] + length)
                for k, lang, a, b in zip(own.tolist(), terms.lang_of[terms.doc[where]].tolist(), begins.tolist(), ends.tolist(), strict=True):
                    if k not in rows:
                        rows[k] = names[lang], data[a:b]
                waiting += len(own)
                if waiting > 2 * HELD:
                    if len(rows) > HELD:
                        yield send()
                    else:
                        held[0], held[1] = ([x] for x in add_up())
                    waiting = len(rows)
        if held[0]:
            yield send()

    return docs.select("lang", "text").mapInArrow(tidy(run), _CANDIDATES)


def _hashed(rows: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """``rows`` with the key of two text columns, the second one a language or source."""
    schema = StructType([*rows.schema, StructField(name, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = _keys(_name_hashes(batch[first]), _name_hashes(batch[second]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key.view(np.int64))], names=[*batch.schema.names, name])

    return rows.mapInArrow(tidy(run), schema)


def _bitmap(left: DataFrame, bits: int) -> np.ndarray:
    """For each slot whether a key of ``left`` falls into it."""
    place = F.pmod(F.col("key"), F.lit(bits))  # ``bits`` is a power of two: the same for signed and unsigned keys
    found = left.select(F.floor(place / _BITMAP_BITS).cast("int").alias("bucket"), (place % _BITMAP_BITS).alias("place"))
    out = np.zeros(bits, dtype=bool)
    for row in found.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bitmap")).collect():  # bits / 8 bytes at most
        out[row.bucket * _BITMAP_BITS : (row.bucket + 1) * _BITMAP_BITS] = np.unpackbits(np.frombuffer(row.bitmap, np.uint8), bitorder="little")
    return out


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, first_length: int = FIRST_LENGTH, bits: int = BITS) -> DataFrame:
    """``lang, term, key`` of every term that occurs in ``min_docs`` documents of its language, by iceberg prefix refinement.
    ``docs`` has ``lang, source, text`` without nulls."""
    kept, shorter, length, left, survivors = None, 1, first_length, None, None
    while True:
        counts = _level(docs, shorter, length, left, bits).groupBy("lang", "term").agg(F.sum("docs").alias("docs"))
        counts = counts.filter(F.col("docs") >= min_docs)
        if survivors is not None:
            known = survivors.select(F.col("lang").alias("_lang"), F.col("term").alias("_prefix"))
            prefix = F.substring("term", 1, shorter)
            counts = counts.join(known, (F.col("lang") == F.col("_lang")) & (prefix == F.col("_prefix")), "left_semi")
        counts = write_once(_hashed(counts.select("lang", "term"), "term", "lang", "key"), "terms-level")
        complete = counts.filter(F.octet_length("term") < length)
        kept = complete if kept is None else kept.unionByName(complete)
        survivors = counts.filter(F.octet_length("term") == length)
        if survivors.isEmpty():
            return kept
        left, shorter, length = _bitmap(survivors, bits), length, 2 * length


def term_uses(docs: DataFrame, kept: DataFrame, bits: int = BITS) -> DataFrame:
    """``owner, key, uses``: how often each kept term occurs in each group, which goes by the hash of language and source."""
    left = _bitmap(kept, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], []]
        waiting = 0

        def add_up() -> list[np.ndarray]:
            owner, key, uses = (np.concatenate(x) for x in held)
            _, at, place = np.unique(_keys(key, owner), return_index=True, return_inverse=True)
            return [owner[at], key[at], np.bincount(place, uses).astype(np.int64)]

        def send(columns: list[np.ndarray]) -> pa.RecordBatch:
            arrays = [pa.array(c.view(np.int64)) for c in columns]
            return pa.RecordBatch.from_arrays(arrays, names=["owner", "key", "uses"])

        for batch in batches:
            for piece in slices(batch, "text"):
                terms = _Slice(piece, 1)
                key = terms.prefixes()
                some = left[_bit(key, bits)]
                sources = piece["source"].dictionary_encode()
                owner = _keys(_name_hashes(sources.dictionary)[sources.indices.to_numpy(zero_copy_only=False)], terms.lang_hash)
                owner, key = owner[terms.doc[some]], key[some]
                _, at, uses = np.unique(_keys(key, owner), return_index=True, return_counts=True)
                for c, values in zip(held, (owner[at], key[at], uses), strict=True):
                    c.append(values)
                waiting += len(at)
                if waiting > 2 * HELD:
                    found = add_up()
                    held = [[], [], []]
                    if len(found[0]) > HELD:
                        yield send(found)
                    else:
                        held = [[x] for x in found]
                    waiting = sum(len(x) for x in held[0])
        if held[0]:
            yield send(add_up())

    found = docs.mapInArrow(tidy(run), "owner long, key long, uses long").groupBy("owner", "key").agg(F.sum("uses").alias("uses"))
    return found.join(kept.select("key"), "key", "left_semi")


def probability(uses: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (uses + SMOOTH) / total)``, exact for totals up to 9e15; no more than ``SCALE + 1``."""
    rest, out = uses + SMOOTH, np.zeros(np.broadcast(uses, total).shape, dtype=np.int64)
    for _ in range(3):  # a thousand at a time, as the product would not fit 64 bits
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return 1 + out


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_FOUND = StructType(
    [
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("part", StringType()),
        StructField("item", StringType()),
        StructField("value", LongType()),
    ]
)
_CELL = ["lang", "block", "a", "b"]
_ROLES = ("source", "term", "use")
_ARROW = pa.schema([(f.name, pa.int64() if f.name == "value" else pa.string()) for f in _FOUND])


class _Cell:
    """A block of terms and two tiles of sources.

    Its rows, by role: the sources with their ``total``, of which the language itself is one without a name; the terms, in
    order of their bytes, with the uses in the whole language; and the uses of each source.
    """

    def __init__(self, lang: str, a: int, b: int):
        self.lang, self.a, self.b = lang, a, b
        self.parts: dict[str, list[pa.RecordBatch]] = {role: [] for role in _ROLES}

    def column(self, role: str, name: str) -> list[pa.Array]:
        return [p[name] for p in self.parts[role]]

    def numbers(self, role: str, name: str) -> np.ndarray:
        return np.concatenate([c.to_numpy() for c in self.column(role, name)]) if self.parts[role] else np.empty(0, np.int64)

    def compared(self, top: int) -> Iterator[pa.RecordBatch]:
        owners, totals = self.numbers("source", "owner"), np.maximum(self.numbers("source", "total"), 1)
        names = [x for c in self.column("source", "name") for x in c.to_pylist()]
        tiles = self.numbers("source", "tile")
        key = self.numbers("term", "key")
        whole = next(i for i, name in enumerate(names) if name is None)
        uses = np.zeros((len(names), len(key)), dtype=np.int64)
        uses[whole] = self.numbers("term", "uses")
        row, column = np.argsort(owners), np.argsort(key)
        at = row[np.searchsorted(owners, self.numbers("use", "owner"), sorter=row)]
        uses[at, column[np.searchsorted(key, self.numbers("use", "key"), sorter=column)]] = self.numbers("use", "uses")
        p = probability(uses, totals[:, None])
        mine = [i for i, name in enumerate(names) if name is not None and tiles[i] == self.a]
        others = mine if self.a == self.b else [i for i, name in enumerate(names) if name is not None and tiles[i] == self.b]
        terms = [x for c in self.column("term", "term") for x in c.to_pylist()] if self.a == self.b else []
        for i in mine:
            value = distance(p[i], p[others]).sum(axis=1).tolist() if others else []
            out = [(names[i], "pair", names[j], v) for j, v in zip(others, value, strict=True) if i != j]
            if self.a != self.b:
                out += [(names[j], "pair", names[i], v) for j, v in zip(others, value, strict=True)]
            else:
                over = np.flatnonzero((uses[i] > 0) & (p[i] > p[whole]))
                value = distance(p[i, over], p[whole, over])
                out += [(names[i], "term", terms[over[j]].decode(), int(value[j])) for j in np.lexsort((over, -value))[:top]]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            arrays = [pa.array([self.lang] * len(out), pa.string()), *[pa.array(c, _ARROW.types[k + 1]) for k, c in enumerate(columns)]]
            yield pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _compare(cells: DataFrame, top: int) -> DataFrame:
    """What each cell adds to the pairs of its sources, and for its terms the ``top`` ones of each source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cell = None, None
        for batch in batches:
            n = batch.num_rows
            change = np.ones(max(n, 1), dtype=bool)
            for c in (*_CELL, "role"):
                change[1:] &= pc.equal(batch[c].slice(1), batch[c].slice(0, max(n - 1, 0))).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(~change[1:]) + 1).tolist(), n] if n else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                key = tuple(batch[c][a].as_py() for c in _CELL)
                if key != now:
                    if cell is not None:
                        yield from cell.compared(top)
                    now, cell = key, _Cell(key[0], key[2], key[3])
                cell.parts[_ROLES[batch["role"][a].as_py()]].append(batch.slice(a, b - a))
        if cell is not None:
            yield from cell.compared(top)

    return cells.repartition(*_CELL).sortWithinPartitions(*_CELL, "role", "term").mapInArrow(tidy(run), _FOUND)


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    first_length: int = FIRST_LENGTH,
    bits: int = BITS,
    block_terms: int = BLOCK_TERMS,
    tile: int = TILE,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each group the other sources (``pair``) and its ``top`` terms (``term``)."""
    none = F.lit("")
    named: list[Column] = [F.coalesce(F.col(c).cast("string"), none).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]
    docs = docs.select(*named)
    kept = write_once(kept_terms(docs, min_docs, first_length, bits), "terms-kept")
    uses = write_once(term_uses(docs, kept, bits), "terms-uses")
    named = uses.join(kept, "key")
    whole = write_once(named.groupBy("lang", "term", "key").agg(F.sum("uses").alias("uses")), "terms-whole")
    terms = whole.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("uses").alias("n"))
    sums = uses.groupBy("owner").agg(F.sum("uses").alias("n"))
    groups = _hashed(docs.groupBy("lang", "source").agg(F.lit(1).alias("_one")).drop("_one"), "source", "lang", "owner")
    zero = F.lit(0).cast("long")
    groups = groups.join(sums, "owner", "left").join(terms.select("lang", "v"), "lang", "left")
    groups = write_once(groups.select("lang", "source", "owner", F.coalesce("n", zero).alias("n"), F.coalesce("v", zero).alias("v")), "terms-groups")
    tiles, blocks = F.ceil(F.count(F.lit(1)) / tile).cast("long"), F.ceil(F.max("v") / block_terms).cast("long")
    shape = groups.groupBy("lang").agg(tiles.alias("tiles"), blocks.alias("blocks"))

    def rows(of: DataFrame, role: str, block: Column, **columns: Column) -> DataFrame:
        """Rows of a role for the cells, without the tiles."""
        fields = {"owner": "long", "name": "string", "tile": "long", "total": "long", "term": "binary", "key": "long", "uses": "long"}
        made = [columns.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in fields.items()]
        return of.select("lang", "tiles", block.alias("block"), F.lit(_ROLES.index(role)).alias("role"), *made)

    total = F.col("n") + F.lit(2) * F.col("v")
    block = F.pmod("key", F.col("blocks"))
    every = F.explode(F.sequence(zero, F.col("blocks") - 1))
    members = groups.filter("v > 0").join(shape, "lang").withColumn("tile", F.pmod("owner", F.col("tiles")))
    mine = {"owner": F.col("owner"), "tile": F.col("tile")}
    heads = rows(members, "source", every, name=F.col("source"), total=total, **mine)
    entries = rows(uses.join(members, "owner"), "use", block, key=F.col("key"), uses=F.col("uses"), **mine)
    # A pair of sources meets in the cell of their tiles, the smaller tile first.
    cells = heads.unionByName(entries).withColumn("other", F.explode(F.sequence(zero, F.col("tiles") - 1)))
    cells = cells.withColumns({"a": F.least("tile", "other"), "b": F.greatest("tile", "other")}).drop("other", "tiles")
    # The language itself, with all its terms, sits in every cell.
    head = rows(terms.join(shape, "lang"), "source", every, owner=zero, total=total, tile=F.lit(-1))
    body = rows(whole.join(shape, "lang"), "term", block, term=F.col("term"), key=F.col("key"), uses=F.col("uses"))
    seats = [F.explode(F.sequence(zero, F.col("tiles") - 1)).alias(c) for c in ("a", "b")]
    everything = head.unionByName(body).select("*", seats[0]).select("*", seats[1]).filter("a <= b").drop("tiles")

    found = write_once(_compare(cells.unionByName(everything), top), "terms-compared")
    fields = ["lang", "source", "part", "item", "value"]
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    bare = groups.filter("v = 0")
    left, right = bare.select("lang", "source"), bare.select("lang", F.col("source").alias("item"))
    empty = left.join(right, "lang").filter("source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", zero.alias("value"))
    by_value = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(by_value)
    pairs = pairs.unionByName(empty).withColumn("rank", rank)
    terms_of = found.filter("part = 'term'").select(*fields).withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.select(*fields, "rank").unionByName(terms_of)
