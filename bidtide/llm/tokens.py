"""Token ids of whole texts by a public tokenizer file, and their fixed-width binary files.

Token ids. Both vocabularies used here split a text at white space before they merge, so ids of a text are the ids of
its space-separated pieces one after another wherever a single space stands between two other characters. Ids of
pieces are remembered (``MEMORY`` of them for each Python worker), which the library itself does not do, and looked up once for
``HELD`` characters of texts; a text with any
other arrangement of white space is cut only at the places where that rule holds. Special tokens' strings are
ordinary text.

Files. Ids are packed into the fewest bits that hold the vocabulary, least significant bit first. A block holds whole
documents, some ``BLOCK_IDS`` ids, and is one row of a Parquet table in the shared folder: shard, block, first (ids of
the shard before it), doc_ids, lengths, bits, payload. Shards are ranges of doc_id in order, so offsets of blocks and the
table of shard sizes give the place of every id; any block unpacks alone with numpy, and any id by its bit offset.

Defined results: a null or empty text has no ids but the end id; documents with equal doc_id keep an order by text; null
doc_ids come first; an empty table gives an empty file set; extra columns are ignored.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from collections.abc import Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidtide.llm.text import per_batch, small_batches, worker_cache
from bidtide.session import fresh_path

if TYPE_CHECKING:
    from tokenizers import Tokenizer

MEMORY = 700_000
#: Characters beyond which a piece is not remembered.
LONG = 64
BLOCK_IDS = 65_536
#: New words that go to the library as one text.
JOINED = 64
#: New pieces that are learnt at once.
TOGETHER = 4096
#: Characters of texts whose pieces are looked up together.
HELD = 1 << 21
_MARKS = ".,;:!?"
#: ASCII's signs, but for the one that begins "'s" and its like.
_SIGNS = r"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""
#: A blank as byte vocabularies write it.
_SPACE = "\u0120"
#: All bytes as byte vocabularies write them, but for ASCII's blank and control characters; some beyond ASCII are another letter.
_BYTE_LETTERS = "".join(chr({b: 0x100 + 33 + i for i, b in enumerate([*range(0x7F, 0xA1), 0xAD])}.get(byte, byte)) for byte in range(256))
#: Up to here, letters are letters to every version of Unicode, composed, and lower-cased to one letter but for U+0130.
_LATIN = "\u024f"
_LOWERED = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_LETTERS = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
_CUT = re.compile(r"(?<=\S)(?= \S)")
_WORKER: dict[str, PieceIds] = worker_cache()


class PieceIds:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.limit = MEMORY
        self.after_space: dict[str, bytes | bool] = {}  # ids of a piece with a space before it; False: not a plain piece
        self.as_is: dict[str, bytes] = {}
        self.edge, self.edges = self._word_edges()
        self.usual, self.bare = self._for_words()
        self.older: dict[str, bytes | bool] = {}
        self.marks: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str, pieces: int = MEMORY) -> PieceIds:
        """The worker's own tokenizer, kept between tasks, which remembers up to ``pieces`` pieces."""
        if path not in _WORKER:
            _WORKER[path] = cls(path)
        _WORKER[path].limit = pieces
        return _WORKER[path]

    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _word_edges(self) -> tuple[str | None, np.ndarray]:
        """Whether ids show where a word of letters with a space before it starts or ends, and the ids that do: those with the space
        itself among bytes, or those with the suffix of a word's end."""
        from tokenizers.pre_tokenizers import ByteLevel

        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix and not (self.tokenizer.normalizer is None and isinstance(self.tokenizer.pre_tokenizer, ByteLevel)):
            return None, np.zeros(0, bool)
        flags = np.zeros(self.vocabulary(), bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            flags[i] = token.endswith(suffix) if suffix else token.startswith(_SPACE)
        return ("end" if suffix else "start"), flags

    def _for_words(self) -> tuple[bool, Tokenizer | None]:
        """Whether the steps before the merges are those of the two known kinds of vocabulary, and a tokenizer with the same merges that
        takes words of letters up to ``_LATIN``, lower-cased for the kind that does so, and cuts at single spaces only: the patterns
        and the normalizer that it leaves out are a third of a new word's cost."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import Split

        steps = json.loads(self.tokenizer.to_str())
        bare = Tokenizer(self.tokenizer.model)
        bare.pre_tokenizer = Split(" ", "removed")
        if self.edge == "start":
            known = steps["pre_tokenizer"]["use_regex"]
            return known, bare if known and not any(t["content"].isalpha() for t in steps["added_tokens"]) else None
        if (steps["normalizer"], steps["pre_tokenizer"]) != (_LOWERED, _LETTERS):
            return False, None
        return True, bare

    def _cuts(self, texts: list[str], tokenizer: Tokenizer) -> Iterator[tuple[bytes, np.ndarray]]:
        """The ids of each text of words, and where its words start, the first one left out."""
        if self.edge is None:
            for e in tokenizer.encode_batch(texts, add_special_tokens=False):
                of_word = np.array(e.word_ids)
                yield array("I", e.ids).tobytes(), np.flatnonzero(of_word[1:] != of_word[:-1]) + 1
            return
        for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(e.ids, np.uint32)
            at = self.edges[ids]
            yield ids.tobytes(), np.flatnonzero(at[:-1] if self.edge == "end" else at[1:]) + 1

    def _of_pieces(self, pieces: list[str]) -> bytes:
        """Ids of adjacent pieces of a text that start anew wherever ``_CUT`` holds."""
        if fresh := list(set(pieces).difference(self.as_is)):
            if len(self.as_is) + len(fresh) > self.limit:
                self.as_is.clear()
                fresh = list(set(pieces))
            self.as_is.update(zip(fresh, self._encoded(fresh)))
        ids = b"".join(map(self.as_is.__getitem__, pieces))
        for piece in fresh:
            if len(piece) > LONG:
                del self.as_is[piece]
        return ids

    @staticmethod
    def _is_latin(word: str) -> bool:
        return word.isascii() or max(word) <= _LATIN and "\u0130" not in word

    def _of_heads(self, words: list[str]) -> list[bytes]:
        """Ids of Latin words of letters without a space before them, where ids show a word's start: a lone space goes between them."""
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        texts = [codecs.charmap_decode(" ".join(g).encode(), "strict", _BYTE_LETTERS)[0].replace(" ", f" {_SPACE} ") for g in groups]
        out = []
        for group, e in zip(groups, self.bare.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            at, raw = np.flatnonzero(self.edges[ids]).tolist(), ids.tobytes()
            if len(at) == len(group) - 1:
                out += [raw[4 * i + 4 : 4 * j] for i, j in zip([-1, *at], [*at, len(ids)])]
            else:
                out += self._encoded(group)
        return out

    def _learn_words(self, words: set[str]) -> None:
        """Remember the ids of words of letters, each with a space before it."""
        known = self.after_space
        latin = [w for w in words if self._is_latin(w)] if self.bare else []
        if others := list(words.difference(latin)):
            known.update(zip(others, self._of_words(others, self.tokenizer)))
        if latin and self.edge == "start":
            known.update(zip(latin, self._of_words(latin, self.bare)))
        elif latin:
            small = [w.lower() for w in latin]
            fresh = list(set(small).difference(known))
            known.update(zip(fresh, self._of_words(fresh, self.bare)))
            known.update(zip(latin, map(known.__getitem__, small)))

    def _of_words(self, words: list[str], tokenizer: Tokenizer) -> list[bytes]:
        """Ids of words of letters, each with a space before it. Such a word is one pre-token, so many go to the library as
        one text, which saves most of its cost for a call; a text that comes back with more pre-tokens is done word by word."""
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        texts, out = [f" {' '.join(g)}" for g in groups], []
        if tokenizer is self.bare:
            texts = [t if t.isascii() else codecs.charmap_decode(t.encode(), "strict", _BYTE_LETTERS)[0] for t in texts]
            if self.edge == "start":
                texts = [t.replace(" ", f" {_SPACE}") for t in texts]
        for group, (raw, starts) in zip(groups, self._cuts(texts, tokenizer)):
            cuts = [0, *(4 * starts).tolist(), len(raw)]
            if len(cuts) == len(group) + 1:
                out += [raw[i:j] for i, j in zip(cuts, cuts[1:])]
            else:
                out += self._encoded([f" {w}" for w in group])
        return out

    def _learn(self, fresh: set[str]) -> None:
        known = self.after_space
        words, marked, broken, others, heads = set(), [], [], [], set()
        todo = list(fresh)
        for p in todo:  # grows by the parts of pieces
            if p.isalpha():
                words.add(p)
            elif p and (core := self._core(p)) is not p:
                marked.append((p, core))
                if core not in known:
                    words.add(core)
            elif self.usual and p.split() == (lines := p.split("\n")) and len(lines) > 1:
                # A line break between two other characters is cut off on both sides; what follows has no space before it.
                broken.append((p, lines))
                after = 1 if self.edge == "start" else len(lines)
                todo += set(lines[:after]).difference(known, fresh)
                heads.update(map(self._core, lines[after:]))
            elif p and p.strip() == p:
                others.append(p)
            else:
                known[p] = False
        self._learn_words(words)
        known.update(zip(others, self._encoded([f" {p}" for p in others])))
        for p, core in marked:
            known[p] = known[core] + self._mark(p[len(core) :])
        if missing := list(heads.difference(self.as_is)):
            if len(self.as_is) + len(missing) > self.limit:
                self.as_is.clear()
                missing = list(heads)
            plain = [w for w in missing if w.isalpha() and self._is_latin(w)] if self.bare and self.edge == "start" else []
            self.as_is.update(zip(plain, self._of_heads(plain)))
            missing = list(set(missing).difference(plain))
            self.as_is.update(zip(missing, self._encoded(missing)))
        for p, lines in broken:
            ids = []
            for i, line in enumerate(lines):
                if i == 0 or self.edge == "end":
                    ids.append(known[line])
                else:
                    core = self._core(line)
                    ids.append(self.as_is[core] + self._mark(line[len(core) :]) if core is not line else self.as_is[line])
            known[p] = self._mark("\n").join(ids)

    def _core(self, piece: str) -> str:
        """The word of a piece that is a word and marks at its end, or the piece. These are never merged, unless the word's lower case
        ends in a combining mark."""
        core = piece.rstrip(_SIGNS) if self.usual else piece[:-1] if piece[-1] in _MARKS else piece
        return core if len(core) < len(piece) and core.isalpha() and core.lower().isalpha() else piece

    def _mark(self, signs: str) -> bytes:
        """Ids of signs at a word's end or of a line break, as they stand."""
        if signs not in self.marks:
            if len(self.marks) >= TOGETHER:
                self.marks.clear()
            self.marks[signs] = self._encoded([signs])[0]
        return self.marks[signs]

    def encode_one(self, text: str) -> bytes:
        return self.encode([text])[0]

    def _known(self, words: list[str]) -> list[bytes | None]:
        """Ids of pieces, each with a space before it; None: not a plain piece."""
        known, older = self.after_space, self.older
        found: list[bytes | bool | None] = list(map(known.get, words))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        fresh = []
        for i in gaps:
            word = words[i]
            if (ids := older.get(word)) is not None:
                found[i] = known[word] = ids
            elif len(word) > LONG:  # not remembered
                found[i] = False
            else:
                fresh.append(i)
        for first in range(0, len(fresh), TOGETHER):
            some = fresh[first : first + TOGETHER]
            self._learn({words[i] for i in some})
            for i in some:
                found[i] = self.after_space[words[i]]
            if len(self.after_space) > self.limit // 2:
                # The older half is forgotten, except for what is met again.
                self.older, self.after_space = self.after_space, {}
        return [ids if ids is not False else None for ids in found]

    def _of_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of some texts: Arrow finds their distinct pieces, and lays the ids of these end to end."""
        split = [text.partition(" ") for text in texts]
        pieces = pc.split_pattern(pa.array([rest if space else None for _, space, rest in split], pa.large_string()), " ")
        distinct = pieces.flatten().dictionary_encode()
        ids = pa.array(self._known(distinct.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        # The first piece of each text, that has no space before it, is left out.
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
        taken = ids.take(distinct.indices)
        plain = np.concatenate([[0], np.cumsum(taken.is_null().to_numpy(zero_copy_only=False))])[ends]
        cuts = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1)[ends].tolist() if len(taken) else [0] * len(ends)
        raw = memoryview(taken.buffers()[2] or b"") if len(taken) else memoryview(b"")
        out = []
        for text, (head, space, _), odd, first, last in zip(texts, split, (plain[1:] - plain[:-1]).tolist(), cuts, cuts[1:]):
            if odd or len(head) > LONG or space and (not head or head[-1].isspace()):
                out.append(self._of_pieces(_CUT.split(text)))
            else:
                out.append((self._of_pieces([head]) if head else b"") + raw[first:last])
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        first, held = 0, 0
        for n, text in enumerate(texts, 1):
            held += len(text)
            if held >= HELD or n == len(texts):
                out += self._of_texts(texts[first:n])
                first, held = n, 0
        return out


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold every id of a vocabulary."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Fixed-width little-endian bit string of the ids."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    spread = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, count: int, first: int = 0) -> np.ndarray:
    """Ids ``first`` to ``first + count`` of a packed block, touching only their own bytes."""
    if bits == 16:
        return np.frombuffer(payload, "<u2", count, first * 2).astype(np.uint32)
    low = first * bits
    raw = np.frombuffer(payload, np.uint8)[low // 8 : -(-(low + count * bits) // 8)]
    flat = np.unpackbits(raw, bitorder="little")[low % 8 : low % 8 + count * bits].reshape(count, bits)
    return (flat.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


_BLOCKS = "shard int, block long, first long, doc_ids array<long>, lengths array<long>, bits int, payload binary"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None, block_ids: int = BLOCK_IDS) -> str:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order; the folder of the files."""
    small_batches(docs)
    path = path or fresh_path(docs.sparkSession, "tokens")
    # Whole partitions of a range of ids: the adaptive planner may merge neighbours, which keeps their order.
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = PieceIds.of(tokenizer), TaskContext.get().partitionId()
        bits, end = bits_for(max(encoder.vocabulary(), end_id + 1)), np.array([end_id], "<u4").tobytes()
        block, first, n, held, doc_ids, lengths = 0, 0, 0, [], [], []

        def closed() -> pa.RecordBatch:
            row = [[shard], [block], [first], [doc_ids], [lengths], [bits], [pack(np.frombuffer(b"".join(held), "<u4"), bits)]]
            types = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], [c.split()[0] for c in _BLOCKS.split(", ")])

        for batch in batches:
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text").to_pylist())):
                held.append(ids + end)
                doc_ids.append(doc_id)
                lengths.append(len(ids) // 4 + 1)
                n += lengths[-1]
                if n >= block_ids:
                    yield closed()
                    block, first, n, held, doc_ids, lengths = block + 1, first + n, 0, [], [], []
        if doc_ids:
            yield closed()

    ordered.mapInArrow(run, _BLOCKS).write.option("compression", "none").parquet(path)
    return path


def read_tokens(spark, path: str) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before), n_tokens, ids (32-bit little-endian).

    Blocks are unpacked where they lie. Only the table of shard sizes, a row per shard, is gathered and sent round.
    """
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n")).orderBy("shard").collect()
    before, total = {}, 0
    for shard, n in sizes:
        before[shard], total = total, total + n

    def rows(batch: pa.RecordBatch) -> dict:
        doc_ids, starts, sizes, ids = [], [], [], []
        for row in batch.to_pylist():
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            values = unpack(row["payload"], row["bits"], int(ends[-1])).astype("<u4")
            doc_ids += row["doc_ids"]
            starts.append(before[row["shard"]] + row["first"] + ends - lengths)
            sizes.append(lengths)
            ids += [values[a:b].tobytes() for a, b in zip(ends - lengths, ends)]
        return {"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(np.concatenate(starts)), "n_tokens": pa.array(np.concatenate(sizes)), "ids": pa.array(ids, pa.binary())}

    return per_batch(blocks, "doc_id long, start long, n_tokens long, ids binary", rows)


def id_at(spark, path: str, shard: int, position: int) -> int:
    """One id by its place in a shard: reads the one block that holds it."""
    row = spark.read.schema(_BLOCKS).parquet(path).where((F.col("shard") == shard) & (F.col("first") <= position)).orderBy(F.desc("first")).first()
    return int(unpack(row.payload, row.bits, 1, position - row.first)[0])


