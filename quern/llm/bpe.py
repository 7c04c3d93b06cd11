"""Byte-level BPE encoding and decoding.

The merges are compiled into a finite-state transducer. A prefix of a piece has one last token: the only token that
ends there and may follow the last token before it. The pending bytes hold several places where the next token can
still begin; as soon as the ways back from all of them share a boundary, the tokens before it are emitted. A state is
the last emitted token and the pending bytes, so lookahead is bounded by what the vocabulary can still match. States
are determinised lazily: an arc is put in the table when it is asked for a second time, before that the live places
are stepped one by one. A piece that has been seen is looked up whole.

Decoding streams: chunks of ids become bytes, and a UTF-8 state machine holds back the bytes of an unfinished
character until the next chunk completes it.
"""

import base64
import gc
import hashlib
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept

#: States and pieces a Python worker keeps; beyond it, the table is begun anew.
MAX_STATES, MAX_PIECES, MAX_PAIRS = 100_000, 250_000, 700_000
NEVER, NONE = 1 << 60, -1
#: Bytes that are stepped between two looks at what is certain, where no arc is made.
LOOK = 256
#: Ids that are decoded at once.
CHUNK = 4096


class State:
    __slots__ = ("arcs", "live", "rest", "tokens")

    def __init__(self, tokens: list, live: list):
        #: tokens[i]: the last token of the first i pending bytes; tokens[0] is the one emitted before them.
        #: live: (i, last token there, what has been read of the next one), for the places where it can begin.
        self.tokens, self.live, self.arcs, self.rest = tokens, live, {}, None


class Transducer:
    """Tokens are ranks; what has been read of a token is a node of the vocabulary's prefix tree, 0 its root."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.packed = {r: r.to_bytes(4, "little") for r in ranks.values()}
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.size = {r: len(t) for t, r in ranks.items()}
        self.child: dict[int, int] = {}
        self.token_at, inner = [NONE], {0}
        for token, r in ranks.items():
            node = 0
            for byte in token:
                inner.add(node)
                to = self.child.get(node << 8 | byte)
                if to is None:
                    to = self.child[node << 8 | byte] = len(self.token_at)
                    self.token_at.append(NONE)
                node = to
            self.token_at[node] = r
        self.inner = bytearray(len(self.token_at))
        for node in inner:
            self.inner[node] = 1
        self.pairs: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.start = State([NONE], [(0, NONE, 0)])
        self.states = {(NONE, b""): self.start}

    def follows(self, a: int, b: int) -> bool:
        """Whether the merges, lowest rank first, leave a and b apart; for no a whether they make b one token."""
        left, right = self.bytes_of.get(a, b""), self.bytes_of[b]
        rank, x, cut = self.ranks.get, left + right, len(left)
        parts = [x[i : i + 1] for i in range(len(x))]
        ends = list(range(1, len(x) + 1))
        costs = [rank(x[i : i + 2], NEVER) for i in range(len(x) - 1)]
        while costs and (least := min(costs)) < NEVER:
            i = costs.index(least)
            if ends[i] == cut:
                return False
            parts[i] += parts.pop(i + 1)
            del ends[i], costs[i]
            if i:
                costs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
            if i < len(costs):
                costs[i] = rank(parts[i] + parts[i + 1], NEVER)
        return parts == ([left, right] if cut else [right])

    def run(self, data: bytes, tokens: list, live: list) -> list:
        """Reads data: appends the last token of every prefix to tokens, and gives the live places after it."""
        child, token_at, inner, pairs = self.child.get, self.token_at, self.inner, self.pairs
        for byte in data:
            last, after = NONE, []
            for at, before, node in live:
                node = child(node << 8 | byte)
                if node is None:
                    continue
                if last == NONE and (token := token_at[node]) != NONE:
                    fits = pairs.get(before << 32 | token)
                    if fits is None:
                        if len(pairs) >= MAX_PAIRS:
                            pairs.clear()
                        fits = pairs[before << 32 | token] = self.follows(before, token)
                    if fits:
                        last = token
                if inner[node]:
                    after.append((at, before, node))
            if last == NONE:
                raise ValueError("a byte of the text has no token of its own in the vocabulary")
            after.append((len(tokens), last, 0))
            tokens.append(last)
            live = after
        return live

    def back(self, tokens: list, p: int) -> bytes:
        """Packed ids of the way back from place p."""
        out = []
        while p:
            out.append(self.packed[tokens[p]])
            p -= self.size[tokens[p]]
        out.reverse()
        return b"".join(out)

    def cut(self, tokens: list, live: list) -> int:
        """The last boundary that the ways back of all live places share."""
        places = {x[0] for x in live}
        while len(places) > 1:
            most = max(places)
            places.remove(most)
            places.add(most - self.size[tokens[most]])
        return places.pop()

    def arc(self, s: State, byte: int, pending: bytes) -> tuple[State, bytes, int]:
        """The state after one more byte, the ids that are certain by then, and how many pending bytes they cover."""
        tokens = s.tokens.copy()
        live = self.run(bytes((byte,)), tokens, s.live)
        cut = self.cut(tokens, live)
        key = (tokens[cut], (pending + bytes((byte,)))[cut:])
        to = self.states.get(key)
        if to is None:
            if len(self.states) >= MAX_STATES:
                self.reset()
            to = self.states[key] = State(tokens[cut:], [(at - cut, x, node) for at, x, node in live])
        s.arcs[byte] = made = (to, self.back(tokens, cut), cut)
        return made

    def tail(self, s: State, data: bytes) -> bytes:
        """Ids of what is left of a piece from state s, stepped without making arcs; pending bytes stay bounded."""
        out, tokens, live = [], s.tokens.copy(), s.live
        for i in range(0, len(data), LOOK):
            live = self.run(data[i : i + LOOK], tokens, live)
            if i + LOOK < len(data):
                cut = self.cut(tokens, live)
                out.append(self.back(tokens, cut))
                tokens, live = tokens[cut:], [(at - cut, x, node) for at, x, node in live]
        out.append(self.back(tokens, len(tokens) - 1))
        return b"".join(out)

    def encode(self, piece: bytes) -> bytes:
        """Ids of one piece as little-endian 32-bit integers. A piece that is a token is that token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return self.packed[whole]
        s, out, begun = self.start, [], 0
        for i, byte in enumerate(piece):
            arc = s.arcs.get(byte)
            if not arc:
                if arc is None:  # an arc is made when it is asked for again
                    s.arcs[byte] = ()
                    out.append(self.tail(s, piece[i:]))
                    return b"".join(out)
                arc = self.arc(s, byte, piece[begun:i])
            s, ids, cut = arc
            if cut:
                out.append(ids)
                begun += cut
        if s.rest is None:
            s.rest = self.back(s.tokens, len(s.tokens) - 1)
        out.append(s.rest)
        return b"".join(out)


class Utf8Machine:
    """Splits a stream of bytes after its last whole character. State: bytes still missing, and the held bytes."""

    def __init__(self):
        self.missing, self.held = 0, b""

    def feed(self, data: bytes) -> bytes:
        """The bytes up to the last character boundary; what follows is held. Malformed bytes pass as they are."""
        data, self.held, self.missing = self.held + data, b"", 0
        for back in range(1, min(4, len(data) + 1)):
            lead = data[-back]
            if lead & 0xC0 != 0x80:
                size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                if size > back:
                    self.missing, self.held, data = size - back, data[-back:], data[:-back]
                break
        return data

    def end(self) -> bytes:
        out, self.held, self.missing = self.held, b"", 0
        return out


def latin_finder(pattern: str):
    """The pattern for texts below U+0250 alone, with the character classes written out for the faster re module."""
    low = [chr(i) for i in (*range(9, 14), *range(32, 0x250))]
    inside = {n: "".join(map(re.escape, filter(regex.compile(rf"\p{{{n}}}").match, low))) for n in "LN"}
    out = re.sub(r"\[[^\]]*\]", lambda m: re.sub(r"\\p\{([LN])\}", lambda c: inside[c[1]], m[0]), pattern)
    return re.compile(re.sub(r"\\p\{([LN])\}", lambda c: f"[{inside[c[1]]}]", out)).findall


class Codec:
    """Pieces by a pattern, ids by the transducer, and back. One for each vocabulary and Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.find, self.fst = regex.compile(pattern).findall, Transducer(ranks)
        self.find_latin, self.other = latin_finder(pattern), re.compile("[^\t-\r -\u024f]").search
        codec, self.old = self, {}

        class Pieces(dict):
            def __missing__(self, piece: str) -> bytes:
                out = codec.old.get(piece) or codec.fst.encode(piece.encode())
                if len(piece) <= 64:
                    if len(self) >= MAX_PIECES:
                        codec.old = dict(self)
                        self.clear()
                    self[piece] = out
                return out

        self.pieces = Pieces()
        gc.freeze()  # the tables stay; without this, every collection walks them again
        gc.set_threshold(100_000, 20, 20)

    def encode(self, text: str) -> bytes:
        find = self.find if self.other(text) else self.find_latin
        return b"".join(map(self.pieces.__getitem__, find(text)))

    def decode(self, ids: bytes, size: int = CHUNK):
        """Chunks of whole characters, from packed ids."""
        machine = Utf8Machine()
        numbers = np.frombuffer(ids, "<u4")
        for i in range(0, len(numbers), size):
            yield machine.feed(b"".join(map(self.fst.bytes_of.__getitem__, numbers[i : i + size].tolist())))
        yield machine.end()


def codec(ranks_text: bytes, pattern: str) -> Codec:
    """The worker's codec for a rank file's content (lines of base64 token and rank)."""
    make = lambda: Codec({base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_text.splitlines())}, pattern)
    return kept((hashlib.sha256(ranks_text).hexdigest(), pattern), make)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids (packed little-endian unsigned 32-bit), n_tokens, ids_sha256, decoded_sha256 of every whole text.

    A null text counts as empty and has no tokens. decoded_sha256 is taken over the bytes that decoding the ids gives.
    Rows keep their number; repeated rows give equal rows; other columns are not read. The rank file is read on the
    driver and broadcast: a vocabulary doesn't grow with the data.
    """
    with open(ranks_path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        c = codec(held.value, pattern)
        for batch in batches:
            for rows in (batch.slice(i, 512) for i in range(0, len(batch), 512)):
                ids, tokens, ids_sha, text_sha = [], [], [], []
                for text in rows.column("text"):
                    packed = c.encode(text.as_py())
                    back = hashlib.sha256()
                    for part in c.decode(packed):
                        back.update(part)
                    ids.append(packed)
                    tokens.append(len(packed) // 4)
                    ids_sha.append(hashlib.sha256(packed).hexdigest())
                    text_sha.append(back.hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(ids, pa.binary()), pa.array(tokens, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    whole = docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"))
    kind = whole.schema["doc_id"].dataType.simpleString()
    return whole.mapInArrow(run, f"doc_id {kind}, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_documents(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, text of the packed ids of encode_documents; malformed bytes become U+FFFD."""
    with open(ranks_path, "rb") as f:
        held = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        c = codec(held.value, pattern)
        for rows in batches:
            texts = ["".join(p.decode("utf-8", "replace") for p in c.decode(x.as_py() or b"")) for x in rows.column("ids")]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
