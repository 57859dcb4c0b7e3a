"""SentencePiece merge encoding by backtracking, and decoding.

An encoding is right when every two neighbouring pieces, joined and merged
again from single characters, fall into the same two pieces. So instead of a
merge queue over the whole text, the encoder walks forward with the longest
piece that starts here (from one Aho-Corasick pass), takes the next shorter one
while the pair with the piece before fails, and goes back a piece when nothing
fits, remembering positions that cannot be completed in a bit field.

Two characters that stand side by side in no piece are never merged, so a text
may be cut between them. The cuts are taken from the vocabulary: before a space
mark, around line feeds, and between other characters and the punctuation that
no piece joins to them. Chunks are kept in a bounded cache of two generations,
and so is, for a piece and the longest piece after it, which one fits there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, tidy

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: The score of two parts that make no piece.
NEVER = float("-inf")
CACHE_WORDS, CACHE_CHUNKS, CACHE_PAIRS, CACHED_CHARS = 180_000, 30_000, 150_000, 64


def load_model(path: str) -> dict:
    """Pieces, scores, kinds and normaliser flags of a ``.model`` file."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(path, "rb") as f:
        m.ParseFromString(f.read())
    n = m.normalizer_spec
    if m.trainer_spec.model_type != 2 or n.precompiled_charsmap or n.remove_extra_whitespaces or m.trainer_spec.treat_whitespace_as_suffix or not n.escape_whitespaces:
        raise ValueError("only merge models with the identity normaliser are supported")
    if any(p.type in (USER, UNUSED) for p in m.pieces):
        raise ValueError("user-defined and unused pieces are not supported")
    return {"pieces": [(p.piece, p.score, p.type) for p in m.pieces], "prefix": n.add_dummy_prefix, "unk_surface": m.trainer_spec.unk_surface, "byte_fallback": m.trainer_spec.byte_fallback}


class Changed(str):
    """The ids of a chunk whose surface is not the chunk."""

    back: str


class PieceCoder:
    """Encoder and decoder of one model; one per Python worker."""

    def __init__(self, model: dict):
        import ahocorasick

        self.prefix, self.unk_surface, self.byte_fallback = model["prefix"], model["unk_surface"], model["byte_fallback"]
        pieces = model["pieces"]
        self.kinds = [k for *_, k in pieces]
        self.names = [p for p, *_ in pieces]
        self.ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.score = {p: s for p, s, k in pieces if k == NORMAL}
        self.unk = next(i for i, k in enumerate(self.kinds) if k == UNKNOWN)
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.known = {p for p in self.ids if len(p) == 1}
        self.surface = [p.replace(MARK, " ") if k == NORMAL else None for p, _, k in pieces]
        self.chunks, self.parts = self._cuts()
        self.states: dict[str, list[tuple[float, str, str]]] = {}  # of pieces that were asked for
        self.search = ahocorasick.Automaton()
        whole = {p for p in self.ids if self.merge(p) == [p]}
        for p in whole:
            self.search.add_word(p, self.ids[p])
        self.search.make_automaton()
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in whole), None) for p in whole}
        self.next = {self.ids[p]: -1 if q is None else self.ids[q] for p, q in self.shorter.items()}
        self.sizes, self.digits = [len(p) for p in self.names], [str(i) for i in range(len(pieces))]
        self.pairs: dict[int, int] = {}
        self.old_pairs: dict[int, int] = {}
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}
        self.words: dict[str, str] = {}
        self.old_words: dict[str, str] = {}

    def _cuts(self):
        """Functions that cut a normal text, and a chunk further, where no piece can span."""
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            self.apart, self.by_word = set(), False
            return (lambda s: [s] if s else []), None
        beside: dict[str, set[str]] = {}
        for p in self.ids:
            for x, y in zip(p, p[1:], strict=False):
                if MARK not in (x, y):
                    beside.setdefault(x, set()).add(y)
                    beside.setdefault(y, set()).add(x)
        apart, stuck = {c for c in map(chr, range(33, 127)) if not c.isalnum()}, set()
        while True:  # with the other signs that pieces join to punctuation; signs joined to letters are out
            near = set().union(*(beside.get(c, set()) for c in apart)) - apart
            if not near:
                break
            stuck |= {c for c in near if c in stuck or c.isalpha() or c.isdecimal()}
            out = {c for c in apart if beside.get(c, set()) & stuck}
            stuck |= out
            apart = (apart | near) - stuck
        p = "".join(map(re.escape, sorted(apart)))
        feed, n = ("\\n|", "\\n") if "\n" not in beside and MARK + "\n" not in self.ids else ("", "")
        self.apart = apart | set("\n" if n else "")
        self.by_word = bool(n) and self.prefix
        marks = rf"{MARK}+[{p}]+|[{p}]+|" if p else ""
        coarse = re.compile(rf"{feed}{MARK}+[^{MARK}{n}]*|[^{MARK}{n}]+").findall
        return coarse, re.compile(rf"{marks}{feed}{MARK}*[^{MARK}{p}{n}]+|{MARK}+").findall if p else None

    def merge(self, s: str, states: list | None = None) -> list[str]:
        """Merge a short string from its characters: best score, then leftmost, first.

        ``states`` gets the score, and the first and the last part before it, of each merge.
        """
        parts, score = list(s), self.score.get
        scores = [score(x + y, NEVER) for x, y in zip(parts, parts[1:], strict=False)]
        while scores and (best := max(scores)) > NEVER:
            if states is not None:
                states.append((best, parts[0], parts[-1]))
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def _states(self, piece: str) -> list[tuple[float, str, str]]:
        """How a piece merges from its characters; the last state is the piece itself."""
        out: list[tuple[float, str, str]] = []
        self.merge(piece, out)
        out.append((NEVER, piece, piece))
        self.states[piece] = out
        return out

    def fits(self, a: str, b: str) -> bool:
        """Whether two pieces, joined and merged again, fall into the same two.

        Each merges as it does alone until a merge over the border between them is
        the best, or as good and further left; then they don't.
        """
        left, right = self.states.get(a) or self._states(a), self.states.get(b) or self._states(b)
        score, i, j = self.score.get, 0, 0
        (x, _, last), (y, first, _) = left[0], right[0]
        while not (over := score(last + first, NEVER)) > x or over < y:
            if x == y == NEVER:
                break
            if x >= y:
                i += 1
                x, _, last = left[i]
            else:
                j += 1
                y, first, _ = right[j]
        return over == NEVER and x == y == NEVER

    def _step(self, last: int, piece: int) -> int:
        """The longest that fits after ``last``, of a piece and the shorter ones it begins with; -1 if none does."""
        if last < 0 or piece < 0:
            return piece
        key = last << 32 | piece
        got = self.old_pairs.get(key)
        if got is None:
            a, names, got = self.names[last], self.names, piece
            while got >= 0 and not self.fits(a, names[got]):
                got = self.next[got]
        if len(self.pairs) >= CACHE_PAIRS:
            self.old_pairs, self.pairs = self.pairs, {}
        self.pairs[key] = got
        return got

    def _walk(self, s: str) -> list[int]:
        """The pieces of a stretch of known characters."""
        out: list[int] = []
        pos, last, sizes, step, search = 0, -1, self.sizes, self._step, self.search.iter_long
        failed: bytearray | None = None  # bits of positions that cannot be completed
        while True:
            pairs = self.pairs.get
            for end, piece in search(s, pos):  # the longest pieces one after another, while they fit
                fit = pairs(last << 32 | piece)
                if fit is None:
                    fit = step(last, piece)
                if fit != piece or failed is not None and failed[end + 1 >> 3] >> (end + 1 & 7) & 1:
                    pos = end + 1 - sizes[piece]
                    break
                out.append(piece)
                last = piece
            else:
                return out
            while fit < 0 or failed is not None and failed[pos + sizes[fit] >> 3] >> (pos + sizes[fit] & 7) & 1:
                if fit < 0:
                    if failed is None:
                        failed = bytearray(len(s) // 8 + 1)
                    failed[pos >> 3] |= 1 << (pos & 7)
                    if not out:
                        raise ValueError("no encoding")
                    fit = out.pop()
                    pos -= sizes[fit]
                    last = out[-1] if out else -1
                fit = step(last, self.next[fit])
            out.append(fit)
            pos += sizes[fit]
            last = fit

    def _chunk(self, s: str) -> list[int]:
        if self.known.issuperset(s):
            return self._walk(s)
        out: list[int] = []
        i, n, known = 0, len(s), self.known
        while i < n:
            j = i
            while j < n and s[j] in known:
                j += 1
            if j > i:
                out += self._walk(s[i:j])
            if j < n:
                if self.byte_fallback:
                    out += [self.byte_id[b] for b in s[j].encode()]
                else:
                    out.append(self.unk)
                j += 1
            i = j
        return out

    def _code(self, chunk: str) -> str:
        """A chunk's ids, joined by commas; with their surface if that is not the chunk with spaces for its marks."""
        if not self.apart.isdisjoint(chunk) and len(parts := self.parts(chunk)) > 1:
            coded = [self.words.get(p[1:]) or self._word(p[1:]) if p[0] == MARK else self.young.get(p) or self._coded(p) for p in parts]
            got = ",".join(coded)
            back = None if {*map(type, coded)} == {str} else "".join(map(_surface, parts, coded))
        else:
            ids, digits = self._chunk(chunk), self.digits
            got, back = ",".join([digits[i] for i in ids]), self._text(ids)
        if back is not None and back != chunk.replace(MARK, " "):
            got = Changed(got)
            got.back = back
        return got

    def _coded(self, chunk: str) -> str:
        """``_code`` of a chunk, kept for the next time."""
        got = self.old.get(chunk) or self._code(chunk)
        if len(chunk) <= CACHED_CHARS:
            if len(self.young) >= CACHE_CHUNKS:
                self.old, self.young = self.young, {}
            self.young[chunk] = got
        return got

    def _word(self, word: str) -> str:
        """The code of a word with a space mark before it."""
        got = self.old_words.get(word) or self._code(MARK + word)
        if len(word) <= CACHED_CHARS:
            if len(self.words) >= CACHE_WORDS:
                self.old_words, self.words = self.words, {}
            self.words[word] = got
        return got

    def encode_batch(self, texts: pa.StringArray) -> list[tuple[int, bytes, bytes]]:
        """``encode_row`` of many texts: Arrow finds the distinct words and joins their codes."""
        texts = pc.fill_null(texts, "")
        plain = pc.and_(pc.and_not(pc.greater(pc.binary_length(texts), 0), pc.match_substring(texts, "  ")), pc.invert(pc.or_(pc.match_substring(texts, MARK), pc.starts_with(texts, " "))))
        out: list = [None] * len(texts)
        if self.by_word and pc.any(plain).as_py():
            lists = pc.split_pattern(texts.filter(plain), " ")
            coded = lists.flatten().dictionary_encode()
            words, new = self.words, self._word
            codes = [words.get(w) or new(w) for w in coded.dictionary.to_pylist()]
            joined = lambda parts, sep: pc.binary_join(pa.ListArray.from_arrays(lists.offsets, pa.array(parts, pa.string()).take(coded.indices)), sep)
            ids, back = joined(codes, ","), texts.filter(plain)
            if {*map(type, codes)} != {str}:
                marked = [MARK + w for w in coded.dictionary.to_pylist()]
                back = pc.utf8_slice_codeunits(joined(list(map(_surface, marked, codes)), ""), 1)  # without the space of the dummy prefix
            found = zip(pc.add(pc.count_substring(ids, ","), 1).to_pylist(), ids.cast(pa.binary()).to_pylist(), back.cast(pa.binary()).to_pylist(), strict=True)
            for i, row in zip(pc.indices_nonzero(plain).to_pylist(), found, strict=True):
                out[i] = row
        for i, done in enumerate(out):
            if done is None:
                n, a, b = self.encode_row(texts[i].as_py())
                out[i] = (n, a.encode(), b.encode())
        return out

    def _normal(self, text: str) -> str:
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def encode_row(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids as text joined by commas, and the decoded text."""
        young, new = self.young, self._coded
        chunks = self.chunks(self._normal(text))
        coded = [young.get(c) or new(c) for c in chunks]
        ids = ",".join(coded)
        back = "".join(map(_surface, chunks, coded))
        if self.prefix and back.startswith(" "):
            back = back[1:]
        return ids.count(",") + 1 if ids else 0, ids, back

    def encode(self, text: str) -> list[int]:
        ids = self.encode_row(text)[1]
        return [int(i) for i in ids.split(",")] if ids else []

    def _text(self, ids: list[int]) -> str:
        """Surface of ids, the space of the dummy prefix kept."""
        parts = [self.surface[i] for i in ids]
        if None not in parts:
            return "".join(parts)
        out, held = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                held.append(b)
                continue
            if held:
                out.append(_utf8(bytes(held)))
                held.clear()
            kind = self.kinds[i]
            out.append(self.unk_surface if kind == UNKNOWN else "" if kind == CONTROL else self.names[i].replace(MARK, " "))
        if held:
            out.append(_utf8(bytes(held)))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of any ids; bytes that are no UTF-8 become U+FFFD one by one."""
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        back = self._text(ids)
        return back[1:] if self.prefix and first is not None and self.kinds[first] == NORMAL and self.names[first].startswith(MARK) else back


def _surface(chunk: str, code: str) -> str:
    """What the ids of a chunk decode to."""
    return code.back if type(code) is Changed else chunk.replace(MARK, " ")


def _utf8(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(data):
            for k in (1, 2, 3, 4):
                try:
                    out.append(data[i : i + k].decode())
                    i += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


#: Rows and bytes up to which Arrow batches are coded together: the more rows, the fewer distinct words a row.
TOGETHER_ROWS, TOGETHER_BYTES = 1000, 2 << 20


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= TOGETHER_ROWS or sum(x.nbytes for x in held) >= TOGETHER_BYTES:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _coder(model) -> PieceCoder:
    return held(("pieces", model.id), lambda: PieceCoder(model.value))


class _Shared:
    """A broadcast with a key for the worker's cache: a digest of all that the model says."""

    def __init__(self, spark, value: dict):
        self.id, self.data = hashlib.sha256(repr(sorted(value.items())).encode()).hexdigest(), spark.sparkContext.broadcast(value)

    @property
    def value(self) -> dict:
        return self.data.value


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``) of every row.

    Null text counts as empty (no ids, both digests those of the empty text).
    Rows that repeat an id are coded one by one; extra columns are ignored;
    an empty table gives an empty result. The file is read on the driver and
    broadcast: executors need no copy.
    """
    model = _Shared(docs.sparkSession, load_model(model_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        coder, sha = _coder(model), hashlib.sha256
        for b in _together(batches):
            n, a, d, all_ids = [], [], [], []
            for count, text, back in coder.encode_batch(b.column(1)):
                n.append(count)
                a.append(sha(text).hexdigest())
                d.append(sha(back).hexdigest())
                if ids:
                    all_ids.append(np.fromstring(text, sep=",", dtype=np.int32) if text else np.zeros(0, np.int32))
            cols, names = [b.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                cols.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
            pa.default_memory_pool().release_unused()  # the words of a batch take 100 MB for a moment

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(tidy(run), schema)
