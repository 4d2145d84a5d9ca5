"""SentencePiece encoding as the shortest path through a weighted transducer, and decoding.

The transducer is compiled from a model file: the normaliser (a space before the text, spaces as ``▁``),
the pieces, and for characters outside all pieces their UTF-8 bytes. Composed with a text, its states
are places in the text together with the last piece; the tropical semiring adds weights along a path
and keeps the least.

* Unigram models: a piece weighs minus its score, and the last piece does not matter.
* BPE models: a piece weighs nothing after a piece beside which it is stable, and is barred (infinite
  weight) elsewhere. Two neighbouring pieces are stable if no merge over their border comes before the
  merges that built them. A sequence of pieces is what merging gives if and only if all neighbours are
  stable, so there is one path of finite weight and it is the model's own encoding. The arcs are made
  when first met and kept.

Where no piece can cross a border, a path must pass through it, so a text is cut there and short parts
are solved once and kept. The store has a fixed size, so memory is bounded by the longest text.

Defined results: a null or empty text has no ids; ids decode to the text with ``▁`` read as a space;
repeated rows are encoded one by one. Models with a character map are refused.
"""

from __future__ import annotations

import gc
import re
import string
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from postlens.llm.common import map_texts

#: A parameter of the queries, not a copy: a public vocabulary on the machine.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MAX_MODEL_BYTES = 64 << 20
SPACE = "▁"
UNIGRAM, BPE = 1, 2
KEPT_PARTS, KEPT_PART_LENGTH, KEPT_ARCS = 250_000, 48, 1_000_000
UNKNOWN_PENALTY = 10.0
NEVER = float("inf")


def message_fields(data: bytes) -> dict[int, list]:
    """The fields of one protocol buffer message: numbers, or bytes where the field has a length."""
    fields: dict[int, list] = {}
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            value = data[at : at + size]
            at += size
        fields.setdefault(key >> 3, []).append(value)
    return fields


class Transducer:
    def __init__(self, model: bytes):
        known = sentencepiece.SentencePieceProcessor(model_proto=model)
        fields = message_fields(model)
        trainer = message_fields(fields.get(2, [b""])[0])
        normaliser = message_fields(fields.get(3, [b""])[0])
        if normaliser.get(2, [b""])[0]:
            raise ValueError("models with a character map are not supported")
        self.kind = trainer.get(3, [UNIGRAM])[0]
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        self.prefix = bool(normaliser.get(3, [1])[0])
        self.trim = bool(normaliser.get(4, [1])[0])
        self.unknown = known.unk_id()
        size = known.get_piece_size()
        self.pieces = [known.id_to_piece(i) for i in range(size)]
        plain = [
            i
            for i in range(size)
            if not (known.is_control(i) or known.is_unknown(i) or known.is_unused(i) or known.is_byte(i))
        ]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if known.is_byte(i)}
        self.weight = {i: -known.get_score(i) for i in range(size)}
        self.unknown_weight = max((self.weight[i] for i in plain), default=0.0) + UNKNOWN_PENALTY
        self.ids = {self.pieces[i]: i for i in plain}
        # A tree of the pieces by character: id (or -1 where more must follow) and what may follow.
        self.trie: dict[str, list] = {}
        for piece, number in self.ids.items():
            level, node = self.trie, None
            for char in piece:
                node = level.setdefault(char, [-1, {}])
                level = node[1]
            node[0] = number
        self.arcs: dict[int, dict[int, bool]] = {}
        self.made = 0
        self.spines: dict[int, tuple | None] = {}
        self.parts: dict[str, array] = {}
        self.older: dict[str, array] = {}
        self.cut = re.compile(self.cuts()).findall
        self.spoken = [b""] * size
        for i in plain:
            self.spoken[i] = self.pieces[i].replace(SPACE, " ").encode()
        for byte, i in self.bytes.items():
            self.spoken[i] = bytes([byte])

    def cuts(self) -> str:
        """The pattern of parts, by the borders that no piece crosses: around newlines, before spaces after
        something else, and between a letter or digit and a mark that follows it in no piece."""
        crossing = any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in self.ids)
        if crossing or any("\n" in piece for piece in self.ids):
            return r"(?s).+"
        pairs = {pair for piece in self.ids for pair in re.findall(r"(?=([^\W_][^\w ]))", piece)}
        by_mark: dict[str, str] = {}
        for mark in set(string.punctuation) - {"_"}:
            by_mark[mark] = "".join(sorted(re.escape(pair[0]) for pair in pairs if pair[1] == mark))
        free = "".join(sorted(re.escape(mark) for mark, letters in by_mark.items() if not letters))
        borders = [rf"(?=[{free}])"] if free else []
        # A mark that follows some letters in pieces is cut off after all others.
        borders += [rf"(?<![{letters}])(?={re.escape(mark)})" for mark, letters in sorted(by_mark.items()) if letters]
        return rf"\n| *[^\W_]+(?:{'|'.join(borders)})| *[^ \n]+| +"

    # ---- arcs of a BPE model ---------------------------------------------------------------------

    def merged(self, piece: str) -> list | None:
        """The tree by which merging builds a piece, ``[text, rank, left, right]``; None if it does not."""
        nodes = [[char, -1.0, None, None] for char in piece]
        while len(nodes) > 1:
            joint = [self.ids.get(a[0] + b[0]) for a, b in zip(nodes, nodes[1:], strict=False)]
            ranks = [NEVER if i is None else self.weight[i] for i in joint]
            least = min(ranks)
            if least == NEVER:
                return None
            at = ranks.index(least)
            nodes[at : at + 2] = [[nodes[at][0] + nodes[at + 1][0], least, nodes[at], nodes[at + 1]]]
        return nodes[0]

    def spine(self, number: int) -> tuple | None:
        """Left and right edge of a piece's tree: ``(text, built, used)`` by rank, from the whole down."""
        if number not in self.spines:
            tree = self.merged(self.pieces[number])
            edges = None
            if tree is not None:
                edges = []
                for side in (2, 3):
                    node, used, edge = tree, NEVER, []
                    while node is not None:
                        edge.append((node[0], node[1], used))
                        used, node = node[1], node[side]
                    edges.append(edge)
                edges = tuple(edges)
            self.spines[number] = edges
        return self.spines[number]

    def stable(self, left: int, right: int) -> bool:
        """Whether no merge over the border comes before the merges on either side."""
        before, after = self.spine(left), self.spine(right)
        if before is None or after is None:
            return False
        for x, x_built, x_used in before[1]:
            for y, y_built, y_used in after[0]:
                joint = self.ids.get(x + y)
                if joint is None or max(x_built, y_built) >= min(x_used, y_used):
                    continue
                # Of merges of one rank, the leftmost comes first.
                if self.weight[joint] < x_used and self.weight[joint] <= y_used:
                    return False
        return True

    # ---- shortest path ---------------------------------------------------------------------------

    def fallback(self, char: str) -> list[int]:
        return [self.bytes[byte] for byte in char.encode()] if self.bytes else [self.unknown]

    def path(self, text: str) -> array:
        return self.merge_path(text) if self.kind == BPE else self.score_path(text)

    def merge_path(self, text: str) -> array:
        """The path of weight 0. A place is reached by one last piece, since what merging gives for the
        beginning of a text is fixed; -1 stands for the start and for bytes, which bar nothing."""
        size = len(text)
        last: list = [None] * (size + 1)
        come = [0] * (size + 1)
        last[0] = -1
        trie = self.trie
        for i, before in enumerate(last):
            if before is None or i == size:
                continue
            node = trie.get(text[i])
            if node is None or (node[0] < 0 and text[i] not in self.ids):
                last[i + 1], come[i + 1] = -1, i
                continue
            arcs = self.arcs.get(before)
            if arcs is None:
                arcs = self.arcs[before] = {}
            j = i
            while node is not None:
                j += 1
                number = node[0]
                if number >= 0:
                    allowed = arcs.get(number)
                    if allowed is None:
                        allowed = arcs[number] = self.allowed(before, number)
                    if allowed:
                        last[j], come[j] = number, i
                if j == size:
                    break
                node = node[1].get(text[j])
        return self.read_back(text, last, come)

    def allowed(self, before: int, number: int) -> bool:
        """Makes an arc. A full store of arcs is emptied; those in use are then made again."""
        self.made += 1
        if self.made > KEPT_ARCS:
            self.arcs, self.made = {}, 0
        return self.spine(number) is not None if before < 0 else self.stable(before, number)

    def score_path(self, text: str) -> array:
        size = len(text)
        cost, last, come = [NEVER] * (size + 1), [None] * (size + 1), [0] * (size + 1)
        cost[0] = 0.0
        for i in range(size):
            j, node = i, self.trie.get(text[i])
            while node is not None:
                j += 1
                number = node[0]
                if number >= 0 and cost[i] + self.weight[number] < cost[j]:
                    cost[j], last[j], come[j] = cost[i] + self.weight[number], number, i
                if j == size:
                    break
                node = node[1].get(text[j])
            if text[i] not in self.ids and cost[i] + self.unknown_weight < cost[i + 1]:
                cost[i + 1], last[i + 1], come[i + 1] = cost[i] + self.unknown_weight, -1, i
        return self.read_back(text, last, come)

    def read_back(self, text: str, last: list, come: list) -> array:
        found: list[int] = []
        at = len(text)
        while at:
            if last[at] is None:
                raise ValueError("the pieces give no path through the text")
            start = come[at]
            found.extend([last[at]] if last[at] >= 0 else self.fallback(text[start:at])[::-1])
            at = start
        return array("i", found[::-1])

    # ---- texts -----------------------------------------------------------------------------------

    def normalised(self, text: str) -> str:
        text = text.replace(SPACE, " ")
        if self.trim:
            text = " ".join(word for word in text.split(" ") if word)
        return " " + text if text and self.prefix else text

    def encode(self, text: str) -> array:
        out = array("i")
        known, add = self.parts.get, out.extend
        for part in self.cut(self.normalised(text)):
            found = known(part)
            if found is None:
                found = self.solved(part)
                known = self.parts.get
            add(found)
        return out

    def solved(self, part: str) -> array:
        """A part's ids. Short parts are kept; a full store becomes the older one, from which parts still in
        use come back."""
        found = self.older.get(part)
        if found is None:
            found = self.path(part.replace(" ", SPACE))
        if len(part) <= KEPT_PART_LENGTH:
            if len(self.parts) >= KEPT_PARTS:
                self.older, self.parts = self.parts, {}
            self.parts[part] = found
        return found

    def decode(self, ids: array) -> str:
        text = b"".join(map(self.spoken.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def transducer(model: bytes) -> Transducer:
    """Compiled once per Python worker. Its tree lives as long as the worker, so the garbage collector need
    not walk it again and again."""
    coder = Transducer(model)
    gc.freeze()
    return coder


def read_model(spark: SparkSession, path: str) -> bytes:
    found = spark.read.format("binaryFile").load(path).select("length", "content").limit(2).collect()
    if len(found) != 1 or found[0]["length"] > MAX_MODEL_BYTES:
        raise ValueError(f"{path} must be one model file of at most {MAX_MODEL_BYTES} bytes")
    return bytes(found[0]["content"])


ENCODED = T.StructType(
    [
        T.StructField("n_pieces", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
        T.StructField("round_trip", T.BooleanType()),
    ]
)


def encode_texts(docs: DataFrame, model_path: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, n_pieces, ids, round_trip)`` for every whole text; ``round_trip`` tells whether the ids
    decode to the normalised text."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(read_model(spark, model_path))

    def work(texts: list) -> list[pa.Array]:
        coder = transducer(model.value)
        whole = [(one or b"").decode("utf-8", "replace") for one in texts]
        flat, sizes, same = array("i"), [], []
        for one in whole:
            ids = coder.encode(one)
            flat.extend(ids)
            sizes.append(len(ids))
            plain = coder.normalised(one)
            same.append(coder.decode(ids) == (plain[1:] if coder.prefix else plain))
        ends = np.r_[0, np.cumsum(np.array(sizes, np.int64))].astype(np.int32)
        values = pa.array(np.frombuffer(flat, np.int32) if len(flat) else np.zeros(0, np.int32))
        ids = pa.ListArray.from_arrays(pa.array(ends), values)
        return [pa.array(sizes, pa.int64()), ids, pa.array(same, pa.bool_())]

    return map_texts(docs, key, text, ENCODED, work)


def decode_ids(coded: DataFrame, model_path: str = MODEL, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(key, text)``: the texts that ids stand for; null ids give null."""
    spark = coded.sparkSession
    model = spark.sparkContext.broadcast(read_model(spark, model_path))
    narrow = coded.select(key, ids)
    schema = f"`{key}` {narrow.schema[key].dataType.simpleString()}, text string"

    def run(batches):
        coder = transducer(model.value)
        for batch in batches:
            texts = [None if one is None else coder.decode(one) for one in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return narrow.mapInArrow(run, schema)
