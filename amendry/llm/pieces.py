"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Text is cut into words, each a run of spaces and what follows it. The distinct new words
of a batch are grouped by length, and all words of one length advance together: at each
position, the hashes of all substrings that end there are probed in the sorted hashes of
the pieces, and the best way to reach the position is stored as a back pointer.

The pieces' scores depend on the kind of model. For a unigram model, the best way is the
highest sum of scores. For a byte-pair model, a way is allowed if its last two pieces
keep their border under the model's merges (tested on the merges inside both pieces that
touch the border); exactly one way is then left, and it is the one that merging gives.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from amendry.llm.rows import add_columns

SPACE = "▁"  # fixed value: how pieces spell a space
USUAL = 3  # characters of a piece; such pieces are tried first
CACHED = 40 << 20  # bytes of known words and their ids after which a task forgets those it does not meet again
HELD = 200  # bytes that a known word takes beside its letters and ids
DECODED = 1 << 18  # ids decoded at once
PART = 1 << 20  # characters whose words are held at once
SLICE = 8 << 20  # bytes of text whose new words are encoded together
MATRIX = 1 << 19  # characters of equal-length words that advance together

_FACTOR = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
_MIX = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_NEVER = np.int64(1) << 40
_BITS = 22


@dataclass
class Vocabulary:
    """Arrays over pieces; the last one stands for any character without a piece of its own."""

    bpe: bool
    prefix: bool  # a space is put before every text
    whole: bool  # some piece has a space behind another character, so texts are not cut into words
    bytes_: list  # text of each id
    byte_ids: np.ndarray  # id of each byte
    unknown: int
    ids: np.ndarray
    size: np.ndarray
    score: np.ndarray
    rank: np.ndarray  # order of merges; -1 for single characters
    left: np.ndarray  # the two pieces a piece is merged from; itself if it is none
    right: np.ndarray
    hashes: np.ndarray  # 2 x pieces
    order: np.ndarray  # pieces by first hash
    keys: np.ndarray  # their first hashes, sorted
    maybe: np.ndarray  # whether a piece's hash starts with these bits
    longest: int


def _mixed(codes: np.ndarray) -> np.ndarray:
    x = (codes.astype(np.uint64) + np.uint64(1))[None] * _MIX.reshape(2, *[1] * codes.ndim)
    return x ^ (x >> np.uint64(29))


def _hash(word: str) -> np.ndarray:
    value = np.zeros(2, np.uint64)
    for x in _mixed(np.array([ord(c) for c in word], np.uint32)).T if word else ():
        value = value * _FACTOR + x
    return value


def _merged(word: str, rank: dict[str, int], without: str) -> list[str]:
    """Symbols left when all merges but one are done, best first, leftmost of equals."""
    parts = list(word)
    while len(parts) > 1:
        ranks = [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank and a + b != without]
        if not ranks:
            break
        _, i = min(ranks)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def load(model_file: str) -> Vocabulary:
    """Read the pieces of a SentencePiece file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    if sp.normalize(" a  b ").lstrip(SPACE) != f"a{SPACE}{SPACE}b{SPACE}" or sp.normalize("ﬁÅ") != sp.normalize("") + f"{SPACE}ﬁÅ":
        raise ValueError("only models that leave characters and spaces as they are")
    every = range(sp.get_piece_size())
    names = [sp.id_to_piece(i) for i in every]
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in every]
    if any(sp.is_unused(i) for i in every):
        raise ValueError("models with unused pieces are not handled")
    text = [
        bytes([int(n[3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else n.replace(SPACE, " ").encode()
        for i, n in enumerate(names)
    ]
    byte_ids = np.full(256, sp.unk_id())
    for i in every:
        if sp.is_byte(i):
            byte_ids[int(names[i][3:5], 16)] = i
    own = [i for i in every if not special[i]]
    words = [names[i] for i in own]
    score = np.array([sp.get_score(i) for i in own], np.float64)
    turn = np.lexsort((np.arange(len(own)), -score))
    rank = np.empty(len(own), np.int64)
    rank[turn] = np.arange(len(own))
    ranks = dict(zip(words, rank.tolist()))
    place = {w: k for k, w in enumerate(words)}
    bpe = _is_bpe(sp)
    left, right = np.arange(len(own) + 1), np.arange(len(own) + 1)
    for k, w in enumerate(words if bpe else ()):
        parts = _merged(w, ranks, w) if len(w) > 1 else [w]
        if len(parts) == 2:
            left[k], right[k] = (place.get(p, k) for p in parts)
    size = np.array([len(w) for w in words] + [1], np.int64)
    hashes = np.array([_hash(w) for w in words] + [np.array([1, 1], np.uint64)], np.uint64).T.copy()
    rank = np.append(np.where(size[:-1] == 1, -1, rank), -1)
    order = np.argsort(hashes[0, :-1])
    maybe = np.zeros(1 << _BITS, bool)
    maybe[hashes[0, :-1] >> np.uint64(64 - _BITS)] = True
    return Vocabulary(
        bpe, True, any(SPACE in w.lstrip(SPACE) for w in words), text, byte_ids, len(own), np.array([*own, sp.unk_id()]),
        size, np.append(score, score.min(initial=0) - 10), rank, left, right, hashes, order, hashes[0, order], maybe,
        int(size.max()),
    )


def _is_bpe(sp) -> bool:
    """Model type from the file's trainer settings (field 2, in it field 3: 1 unigram, 2 byte-pair)."""

    def fields(data: bytes):
        at = 0

        def number():
            nonlocal at
            value = shift = 0
            while True:
                byte, at = data[at], at + 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            key = number()
            if key & 7 == 0:
                yield key >> 3, number()
            elif key & 7 == 2:
                size = number()
                yield key >> 3, data[at : at + size]
                at += size
            else:
                at += {1: 8, 5: 4}[key & 7]

    trainer = next((v for k, v in fields(sp.serialized_model_proto()) if k == 2), b"")
    return next((v for k, v in fields(trainer) if k == 3), 1) == 2


# ---- encoding


def _probe(v: Vocabulary, first: np.ndarray, second) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose text is a piece, and the pieces. `second` gives the second hashes of some rows."""
    rows = np.flatnonzero(v.maybe[first >> np.uint64(64 - _BITS)])
    spot = np.searchsorted(v.keys, first[rows])
    spot[spot == len(v.keys)] = 0
    piece = v.order[spot]
    same = (v.keys[spot] == first[rows]) & (v.hashes[1][piece] == second(rows))
    return rows[same], piece[same]


def _power(n: int) -> np.ndarray:
    out = np.ones((2, n + 1), np.uint64)
    for k in range(n):
        out[:, k + 1] = out[:, k] * _FACTOR
    return out


def _keeps_border(v: Vocabulary, a: np.ndarray, b: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Whether merging the text of a and b gives just a and b.

    Undoing the merges of both, the last first, shows every pair of symbols that meets at
    the border. Such a pair would have merged if its merge comes before the one that took
    either symbol away; of equal merges the left one is done first.
    """
    good = np.ones(len(a), bool)
    left_end, right_end = np.full(len(a), _NEVER), np.full(len(a), _NEVER)
    rows = np.arange(len(a))
    a, b = a.copy(), b.copy()
    while len(rows):
        joined = [lambda r, k=k: v.hashes[k][a[r]] * power[k][v.size[b[r]]] + v.hashes[k][b[r]] for k in (0, 1)]
        known, merge = _probe(v, joined[0](slice(None)), joined[1])
        rank = v.rank[merge]
        known = known[(rank < left_end[known]) & (rank <= right_end[known]) & (a[known] != v.unknown) & (b[known] != v.unknown)]
        crossed = np.zeros(len(rows), bool)
        crossed[known] = True
        good[rows[known]] = False
        ra, rb = v.rank[a], v.rank[b]
        undo_a = (ra > rb) & (v.right[a] != a)
        undo_b = ~undo_a & (v.left[b] != b)
        undo_a |= ~undo_b & (v.right[a] != a)
        left_end, a = np.where(undo_a, ra, left_end), np.where(undo_a, v.right[a], a)
        right_end, b = np.where(undo_b, rb, right_end), np.where(undo_b, v.left[b], b)
        on = ~crossed & (undo_a | undo_b)
        rows, a, b, left_end, right_end = (x[on] for x in (rows, a, b, left_end, right_end))
    return good


def _viterbi(v: Vocabulary, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Back pointers of words of one length, a row of code points each: piece that ends at a position, and its size."""
    n, length = codes.shape
    power = _power(max(length, 2 * v.longest))
    mixed = _mixed(codes)
    prefix = np.zeros((2, n, length + 1), np.uint64, order="F")
    for j in range(length):
        prefix[:, :, j + 1] = prefix[:, :, j] * _FACTOR[:, None] + mixed[:, :, j]
    last = np.full((n, length + 1), v.unknown, order="F")
    back = np.ones((n, length + 1), np.int64, order="F")
    best = np.full((n, length + 1), -np.inf, order="F")
    best[:, 0] = 0
    turns = sorted(range(1, v.longest + 1), key=lambda l: abs(l - USUAL))
    for j in range(1, length + 1):
        left = np.arange(n)  # with merges there is one way only, so words that have theirs are done
        for l in (t for t in turns if t <= j):
            i = j - l
            part = [lambda r, k=k: prefix[k, left[r], j] - prefix[k, left[r], i] * power[k, l] for k in (0, 1)]
            rows, p = _probe(v, part[0](slice(None)), part[1])
            if l == 1:
                every = np.full(len(left), v.unknown)
                every[rows] = p
                rows, p = left, every
            else:
                rows = left[rows]
            open_ = best[rows, i] > -np.inf
            rows, p = rows[open_], p[open_]
            if not len(rows):
                continue
            if v.bpe:
                fits = _keeps_border(v, last[rows, i], p, power) if i else np.ones(len(rows), bool)
                # single pieces that merging never makes are no way to write their text
                made = (v.size[p] == 1) | (v.left[p] != p)
                value = np.where(fits & made, 0.0, -np.inf)
            else:
                value = best[rows, i] + v.score[p]
            better = value > best[rows, j]
            rows, p = rows[better], p[better]
            best[rows, j], last[rows, j], back[rows, j] = value[better], p, l
            if v.bpe:
                left = left[best[left, j] == -np.inf]
                if not len(left):
                    break
    return last, back


def encode_words(v: Vocabulary, words: list[str]) -> list[bytes]:
    """Ids of each word, as little-endian unsigned 32-bit numbers."""
    out: list[bytes] = [b""] * len(words)
    sizes = np.array([len(w) for w in words], np.int64)
    for length in np.unique(sizes).tolist():
        own = np.flatnonzero(sizes == length)
        if not length:
            continue
        step = max(1, MATRIX // length)
        for at in range(0, len(own), step):
            rows = own[at : at + step].tolist()
            text = "".join([words[r] for r in rows])
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(rows), length)
            last, back = _viterbi(v, codes)
            line, end = np.arange(len(rows)), np.full(len(rows), length)
            steps = []
            while len(line):
                steps.append((line, end, last[line, end]))
                end = end - back[line, end]
                line, end = line[end > 0], end[end > 0]
            lines, ends, pieces = (np.concatenate(x) for x in zip(*steps))
            turn = np.lexsort((ends, lines))
            lines, ends, pieces = lines[turn], ends[turn], pieces[turn]
            ids, sizes_out = _spelt_out(v, codes, lines, ends, pieces)
            cuts = (4 * np.concatenate([[0], np.cumsum(np.bincount(lines, sizes_out, len(rows)))])).astype(np.int64).tolist()
            flat = ids.tobytes()
            for r, x, y in zip(rows, cuts, cuts[1:]):
                out[r] = flat[x:y]
    return out


def _spelt_out(v: Vocabulary, codes, lines, ends, pieces) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces in order, with the bytes of characters without a piece, and how many each piece takes."""
    sizes = np.ones(len(pieces), np.int64)
    odd = np.flatnonzero(pieces == v.unknown)
    chars, kind = np.unique(codes[lines[odd], ends[odd] - 1], return_inverse=True)
    spelt = [v.byte_ids[list(chr(c).encode("utf-8", "surrogatepass"))] for c in chars.tolist()]
    sizes[odd] = np.array([len(x) for x in spelt], np.int64)[kind]
    place = np.cumsum(sizes) - sizes
    ids = np.empty(int(sizes.sum()), "<u4")
    ids[place] = v.ids[pieces]
    for k, x in enumerate(spelt):
        at = place[odd[kind == k]]
        for n, i in enumerate(x.tolist()):
            ids[at + n] = i
    return ids, sizes


_WORD = re.compile(" +[^ ]*")


class Encoder:
    """Encodes texts; remembers the ids of words, in at most about CACHED bytes and the words of one call."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.known, self.held = vocabulary, {}, 0

    def _words(self, texts: list[str]) -> list[list[str]]:
        spaced = [" " + t.replace(SPACE, " ") if t else "" for t in texts]
        return [[t] if t and self.vocabulary.whole else _WORD.findall(t) for t in spaced]

    def _parts(self, texts: list[str]):
        """Texts in parts of about PART characters, whose words are held at once."""
        begin, size = 0, 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= PART or k == len(texts) - 1:
                yield texts[begin : k + 1]
                begin, size = k + 1, 0

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; all words not known yet are encoded together."""
        seen: set[str] = set()
        for part in self._parts(texts):
            seen.update(*self._words(part))
        if self.held > CACHED:  # words met again stay known
            self._remember({w: self.known[w] for w in seen if w in self.known})
        words = list(seen.difference(self.known))
        coded = encode_words(self.vocabulary, [w.replace(" ", SPACE) for w in words])
        self.known.update(zip(words, coded))
        self.held += self._size(words, coded)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for part in self._parts(texts) for words in self._words(part)]

    def _remember(self, known: dict[str, bytes]) -> None:
        self.known, self.held = known, self._size(known, known.values())

    @staticmethod
    def _size(words, coded) -> int:
        return HELD * len(words) + sum(map(len, words)) + sum(map(len, coded))


class Decoder:
    """Text of ids, piece by piece; no more than DECODED ids are spelt out at once."""

    def __init__(self, v: Vocabulary):
        self.prefix = v.prefix
        self.size = np.array([len(b) for b in v.bytes_], np.int32)
        self.begin = (np.cumsum(self.size) - self.size).astype(np.int32)
        self.store = np.frombuffer(b"".join(v.bytes_), np.uint8)

    def _spelt(self, flat: np.ndarray) -> tuple[bytes, np.ndarray]:
        """UTF-8 bytes of the ids side by side, and where each id's bytes end."""
        count = self.size[flat]
        ends = np.cumsum(count, dtype=np.int32)
        spots = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        spots += np.repeat(self.begin[flat] - (ends - count), count)
        return self.store[spots].tobytes(), ends

    def _bare(self, text: bytes) -> bytes:
        """Without the space put in front."""
        return text[1:] if self.prefix and text[:1] == b" " else text

    def __call__(self, flat: np.ndarray, cuts: np.ndarray):
        """Texts of flat[cuts[k] : cuts[k + 1]], one after another."""
        at, last = 0, len(cuts) - 1
        while at < last:
            stop = max(at + 1, int(np.searchsorted(cuts, cuts[at] + DECODED, "right")) - 1)
            if cuts[stop] - cuts[at] > DECODED:  # one long text
                parts = range(int(cuts[at]), int(cuts[stop]), DECODED)
                yield self._bare(b"".join(self._spelt(flat[p : min(p + DECODED, int(cuts[stop]))])[0] for p in parts))
            else:
                raw, ends = self._spelt(flat[cuts[at] : cuts[stop]])
                after = np.concatenate([[0], ends])[cuts[at : stop + 1] - cuts[at]].tolist()
                yield from (self._bare(raw[a:b]) for a, b in zip(after, after[1:]))
            at = stop


def decode(v: Vocabulary, ids: list[np.ndarray]) -> list[bytes]:
    """UTF-8 text of each array of ids."""
    cuts = np.cumsum([0, *[len(i) for i in ids]])
    return list(Decoder(v)(np.concatenate([np.empty(0, np.int64), *[np.asarray(i, np.int64) for i in ids]]), cuts))


# ---- Spark


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


_last: dict[str, tuple[Encoder, Decoder]] = {}


def _coder(sent, name: str) -> tuple[Encoder, Decoder]:
    """The coder a worker process used last, with the words it knows, or a new one."""
    if name not in _last:
        _last.clear()
        _last[name] = Encoder(sent.value), Decoder(sent.value)
    return _last[name]


def add_ids(
    df: DataFrame,
    model_file: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str | None = None,
    same: str | None = None,
) -> DataFrame:
    """df + array<int> `ids`; if named, the text `decoded` from them and whether it is the `same` text again.

    Null and empty texts have no ids and decode to an empty text, which counts as the
    same. Equal texts get equal ids; an empty table stays empty; a text of any length is
    encoded whole, its words in parts. All rows and other columns stay; columns with the
    new names are replaced. The vocabulary is read once on the driver and sent to the
    tasks; it does not grow with the data.
    """
    v = load(model_file)
    sent = df.sparkSession.sparkContext.broadcast(v)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(decoded, T.StringType())] if decoded else []
    fields += [T.StructField(same, T.BooleanType())] if same else []
    name = hashlib.sha256(Path(model_file).read_bytes()).hexdigest()

    def compute(texts):
        encoder, decoder = _coder(sent, name)
        raw = texts.cast(pa.binary())
        found = encoder([_text(t) for t in raw.to_pylist()])
        cuts = np.cumsum([0, *[len(f) // 4 for f in found]])
        flat = np.frombuffer(b"".join(found), np.int32)
        del found
        columns = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))]
        if decoded:
            columns.append(pa.array([b.decode("utf-8", "replace") for b in decoder(flat, cuts)], pa.string()))
        if same:
            columns.append(pa.array([b == (t.as_py() or b"") for b, t in zip(decoder(flat, cuts), raw)], pa.bool_()))
        return columns

    return add_columns(df, [text], fields, compute, SLICE)
