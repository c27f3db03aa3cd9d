"""BPE encoding by a transducer with bounded lookahead, and incremental decoding.

Let a pre-token be read byte by byte. More bytes can change the tokens of what was
read, but only near its end: tokens left of some border stay, and a merge rule can
move that border by at most one token, the rule's left part, when its right part
begins at the border in one of the two readings. Rules act in the order of their
ranks, so a border moves along a chain of rules of rising rank in which the left
part of each is at the left edge of the next one's right part. ``lookahead`` is the
longest such chain in bytes, found in one pass over the merge list: a token whose
end lies that far behind the last byte read is final. The transducer emits final
tokens and keeps the rest, ``lookahead`` + ``STEP`` bytes at most, whatever the
length of the text. (As no merge ever crosses a border of the final tokens, what
follows a border can be encoded by itself.)

Many pre-tokens go through it at once: in each round every one of them merges the
pair of the least rank it holds, wherever it stands. Distinct pre-tokens of a batch
are encoded, others looked up in a memo of bounded size.

Decoding is a state machine over the bytes of the ids: it holds the bytes of an
unfinished character, emits the others, and turns ill-formed ones into U+FFFD.

Defined cases: a null or empty text has no ids and decodes to the empty text; rows
that repeat are encoded each; a null ``doc_id`` stays null; an empty table gives an
empty result; extra columns are ignored; very long texts and pre-tokens are read in
blocks.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeshore.llm.common import table
from lakeshore.llm.pretokens import BatchEncoder, character_classes, visible_bytes

STEP = 4096  # bytes of a long pre-token read between two emissions
_SHORT = 64  # bytes of pre-tokens that go together
_TOGETHER = 1 << 21  # bytes of pre-tokens merged at a time
_ROOM = 400_000  # pre-tokens remembered, twice as many at most
_IDS = 1 << 16  # ids decoded at a time
_NONE = np.iinfo(np.int32).max
_MACHINES: dict[str, "Transducer"] = {}


def sufficient_lookahead(merges: Iterable[tuple[str, str]]) -> int:
    """Bytes by which a token must lie behind the end of what was read to be final."""
    moved: dict[str, int] = {}  # by the left part: the longest chain that ends with one of its rules
    inside: dict[str, int] = {}  # by token: the same over the tokens of its left edge when it was made
    longest = 0
    for left, right in merges:
        if any(len(part) > 1 and part not in inside for part in (left, right)):
            raise ValueError("a merge comes before the tokens it joins")
        chain = len(left) + max(moved.get(right, 0), inside.get(right, 0))
        moved[left] = max(moved.get(left, 0), chain)
        inside[left + right] = max(inside.get(left, 0), moved[left])
        longest = max(longest, chain)
    return longest


class MergeRules:
    """The merge list as arrays: ranks of pairs, the token that a rule makes, bytes of tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        ):
            raise ValueError(f"{path} is not a plain byte-level BPE model")
        vocab = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        shown = visible_bytes()
        self.byte_ids = np.array([vocab[c] for c in shown], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self.keys = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        self.lookahead = sufficient_lookahead(merges)
        of_char = {c: b for b, c in enumerate(shown)}
        tokens = {i: bytes(of_char[c] for c in t) for t, i in vocab.items() if all(c in of_char for c in t)}
        tokens |= {t["id"]: t["content"].encode() for t in spec["added_tokens"]}
        self.tokens = pa.array([tokens.get(i, b"") for i in range(max(tokens) + 1)], pa.large_binary())
        self.sizes = np.diff(np.frombuffer(self.tokens.buffers()[1], np.int64)[: len(self.tokens) + 1])
        # ranks by hashed pair; a pair whose place is taken goes to the next table
        self.slots, left = [], np.arange(len(self.keys))
        while len(left):
            slots = np.full(1 << 18, -1, np.int32)
            place = self._place(self.keys[left], len(self.slots))
            slots[place[::-1]] = left[::-1]
            self.slots.append(slots)
            left = left[slots[place] != left]

    @staticmethod
    def _place(keys: np.ndarray, turn: int) -> np.ndarray:
        factor = np.uint64((0x9E3779B97F4A7C15 + 2 * turn * 0x632BE59BD9B4E019) % (1 << 64))
        return ((keys.view(np.uint64) * factor) >> np.uint64(46)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, or the largest number."""
        keys = left << 32 | right
        rank = self.slots[0][self._place(keys, 0)]
        for turn, slots in enumerate(self.slots[1:], 1):
            taken = np.flatnonzero((rank >= 0) & (self.keys[rank] != keys))
            rank[taken] = slots[self._place(keys[taken], turn)]
        return np.where((rank >= 0) & (self.keys[rank] == keys), rank, _NONE)

    def merge(self, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the non-empty pieces of ``data`` that begin at ``first``, and the first id of each."""
        ids = self.byte_ids[data]
        owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(data))))
        rank = np.full(len(ids), _NONE, np.int32)  # of the pair that begins here
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.ranks(ids[inner], ids[inner + 1])
        done_ids, done_owner = [], []
        while len(ids):
            heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            sizes = np.diff(np.append(heads, len(ids)))
            least = np.minimum.reduceat(rank, heads)
            if (least == _NONE).any():
                ended = np.repeat(least == _NONE, sizes)
                done_ids.append(ids[ended])
                done_owner.append(owner[ended])
                going = ~ended
                ids, owner, rank = ids[going], owner[going], rank[going]
                least, sizes = least[least != _NONE], sizes[least != _NONE]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            # of equal pairs that overlap, the left one goes first
            run = np.flatnonzero(np.append(True, np.diff(at) > 1))
            nth = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[nth % 2 == 0]
            ids[at] = self.made[rank[at]]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # places after the right parts are gone
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            changed = np.zeros(len(ids), bool)
            changed[at] = changed[at[at > 0] - 1] = True
            touched = np.flatnonzero(changed)
            rank[touched] = _NONE
            touched = touched[touched + 1 < len(ids)]
            touched = touched[owner[touched] == owner[touched + 1]]
            rank[touched] = self.ranks(ids[touched], ids[touched + 1])
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.searchsorted(owner[order], np.arange(len(first)))


class Transducer:
    """Reads a pre-token in pieces and emits its ids as soon as they are final."""

    def __init__(self, rules: MergeRules):
        self.rules, self.held = rules, np.zeros(0, np.uint8)

    def feed(self, data: np.ndarray) -> np.ndarray:
        self.held = np.concatenate([self.held, data])
        if len(self.held) <= self.rules.lookahead:
            return np.zeros(0, np.int64)
        ids, _ = self.rules.merge(self.held, np.zeros(1, np.int64))
        ends = np.cumsum(self.rules.sizes[ids])
        final = int(np.searchsorted(ends, len(self.held) - self.rules.lookahead, side="right"))
        if final:
            self.held = self.held[ends[final - 1] :]
        return ids[:final]

    def close(self) -> np.ndarray:
        held, self.held = self.held, self.held[:0]
        return self.rules.merge(held, np.zeros(1, np.int64))[0] if len(held) else np.zeros(0, np.int64)

    def encode(self, piece: bytes) -> np.ndarray:
        """The ids of one pre-token of any length."""
        data = np.frombuffer(piece, np.uint8)
        out = [self.feed(data[a : a + STEP]) for a in range(0, len(data), STEP)]
        return np.concatenate([*out, self.close()])

    def encode_all(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each pre-token as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        short = []
        for i, p in enumerate(pieces):
            if len(p) > _SHORT:
                out[i] = self.encode(p).astype("<u4").tobytes()
            elif p:
                short.append(i)
        size, group = 0, []
        for i in [*short, -1]:
            if group and (i < 0 or size >= _TOGETHER):
                sizes = np.array([len(pieces[k]) for k in group])
                data = np.frombuffer(b"".join(pieces[k] for k in group), np.uint8)
                ids, first = self.rules.merge(data, np.cumsum(sizes) - sizes)
                raw, cuts = ids.astype("<u4").tobytes(), np.append(first, len(ids)) * 4
                for k, a, b in zip(group, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    out[k] = raw[a:b]
                size, group = 0, []
            if i >= 0:
                group.append(i)
                size += len(pieces[i])
        return out


class TextDecoder:
    """Ids in, text out; bytes of an unfinished character wait for the next ids."""

    def __init__(self, rules: MergeRules):
        self.rules = rules
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray, last: bool = False) -> str:
        """The text that ``ids`` complete; an id outside the vocabulary stands for nothing."""
        known = ids[ids < len(self.rules.tokens)]
        taken = self.rules.tokens.take(pa.array(known, pa.int64()))
        raw = taken.buffers()[2]
        return self.machine.decode(raw.to_pybytes() if raw is not None else b"", last)

    def decode(self, ids: np.ndarray) -> str:
        parts = [self.feed(ids[a : a + _IDS]) for a in range(0, len(ids), _IDS)]
        return "".join([*parts, self.feed(ids[:0], True)])


def transducer(path: str) -> Transducer:
    if path not in _MACHINES:
        _MACHINES[path] = Transducer(MergeRules(path))
    return _MACHINES[path]


def encode_documents(docs: DataFrame, tokenizer: str, digests: bool = False) -> DataFrame:
    """doc_id, ids, decoded text of each row of ``docs`` (doc_id, text).

    With ``digests``: doc_id, n_tokens, ids_sha256, decoded_sha256 instead, made batch by batch.
    """
    spark = docs.sparkSession
    classes = spark.sparkContext.broadcast(character_classes(Tokenizer.from_file(tokenizer)))  # a byte a code point

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        encoder = BatchEncoder(tokenizer, classes.value, machine.encode_all, _ROOM)
        decoder = TextDecoder(machine.rules)
        shown = pa.array([f"{i},".encode() for i in range(len(machine.rules.tokens))], pa.large_binary())
        for batch in batches:
            ids, first = encoder.encode(batch.column("text"))
            rows = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            texts = (decoder.decode(ids[a:b]) for a, b in rows)
            if not digests:
                lists = pa.LargeListArray.from_arrays(pa.array(first, pa.int64()), pa.array(ids, pa.int32()))
                yield pa.record_batch(
                    [batch.column("doc_id"), lists.cast(pa.list_(pa.int32())), pa.array(texts, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )
                continue
            written = shown.take(pa.array(ids, pa.int64()))
            places = np.frombuffer(written.buffers()[1], np.int64)[: len(ids) + 1][first] if len(ids) else first
            raw = memoryview(written.buffers()[2] or b"")
            cuts = zip(places[:-1].tolist(), places[1:].tolist(), strict=True)
            columns = [
                batch.column("doc_id"),
                pa.array(np.diff(first), pa.int64()),
                pa.array([hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in cuts], pa.string()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
            ]
            yield pa.record_batch(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    if digests:
        return named.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    return named.mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")


def op12_bpe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again."""
    return encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests=True)
