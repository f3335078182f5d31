"""Exact BPE encoding by backtracking, and decoding by an offset table.

Encoding a word: one Aho-Corasick pass finds every vocabulary token that
occurs in it. The encoder then takes the longest token at each place whose
pair with the token before it is compatible (merging the two tokens' symbols by
the plain rule gives the two tokens again), and steps back where none is. Each
place is given up at most once, so the time is linear in the word's length, and
a chain of compatible pairs is the encoding that the merges give.

Words repeat, so their ids are kept in a bounded table in each Python worker.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.llm.common import batches, kept, mapped

BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BEYOND = re.compile("[\U00010000-\U0010ffff]").search
MAX_MODEL_BYTES = 64 << 20
CACHE_ENTRIES = 300_000  # words whose ids a Python worker keeps, at about 200 bytes


def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level
    vocabularies: itself where printable, else the next from U+0100 on."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


def _pattern(text: str) -> regex.Pattern:
    # \s is the White_Space property, as in the library; str.isspace() has more
    return regex.compile(text.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
                         .replace(r"\S", r"\P{White_Space}"))


def _ranges(name: str) -> str:
    """The characters up to U+FFFF of a property, as a set for ``re``."""
    every = "".join(map(chr, range(0x10000)))
    return "".join(f"\\u{m.start():04x}-\\u{m.end() - 1:04x}" for m in regex.finditer(rf"\p{{{name}}}+", every))


def narrow_pattern(text: str) -> re.Pattern:
    """``_pattern`` for texts without characters beyond U+FFFF: the same pieces
    from the faster module, which has no property classes."""
    letter, number, blank = _ranges("L"), _ranges("N"), _ranges("White_Space")
    text = text.replace(r"[^\s\p{L}\p{N}]", f"[^{blank}{letter}{number}]")
    for name, chars in ((r"\p{L}", letter), (r"\p{N}", number), (r"\s", blank)):
        text = text.replace(f"[{name}]", f"[{chars}]").replace(name, f"[{chars}]")
    return re.compile(text.replace(r"\S", f"[^{blank}]"))


class Bounded(dict):
    """A table that starts anew when it is full."""

    def put(self, key, value):
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        self[key] = value
        return value


class Bpe:
    """Encoder and decoder of a ``tokenizers`` JSON file with a BPE model and a
    byte-level pre-tokenizer; other kinds raise ValueError."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        if model["type"] != "BPE" or model["dropout"] or model["continuing_subword_prefix"]:
            raise ValueError("only plain BPE models")
        self.suffix = model["end_of_word_suffix"] or ""
        self._normalizer(spec["normalizer"])
        self._splitter(spec["pre_tokenizer"])
        self.added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        if any(a[k] for a in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only plain added tokens")
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self._build(model)
        self._offsets(model["vocab"], spec["decoder"])
        self.words, self.pairs, self.whole = Bounded(), Bounded(), {}

    def _normalizer(self, spec) -> None:
        steps = spec["normalizers"] if spec and spec["type"] == "Sequence" else [spec] if spec else []
        kinds = [s["type"] for s in steps]
        if kinds not in ([], ["NFC", "Replace", "Lowercase"]) or kinds and (
                steps[1]["pattern"] != {"Regex": r"\s+"} or steps[1]["content"] != " "):
            raise ValueError(f"normalizer {kinds}")
        self.lower = bool(kinds)

    def _splitter(self, spec) -> None:
        parts = spec["pretokenizers"] if spec["type"] == "Sequence" else [spec]
        last = parts[-1]
        if last["type"] != "ByteLevel" or last["add_prefix_space"] or len(parts) > 2:
            raise ValueError("pre-tokenizer")
        if len(parts) == 2:
            if parts[0]["type"] != "Split" or not parts[0]["invert"] or parts[0]["behavior"] != "Removed":
                raise ValueError("pre-tokenizer")
            pattern = parts[0]["pattern"]["Regex"]
        else:
            pattern = BYTE_LEVEL_PATTERN
        self.pattern, self.narrow = _pattern(pattern), narrow_pattern(pattern)

    def _build(self, model) -> None:
        """Symbols are bytes 0-255, and 256-511 for a word's last byte where
        the vocabulary marks word ends."""
        vocab, chars, suffix = model["vocab"], byte_chars(), self.suffix
        base = [vocab[c] for c in chars] + ([vocab[c + suffix] for c in chars] if suffix else [])
        size = 1 + max(vocab.values())
        self.spell = [""] * size
        for symbol, i in enumerate(base):
            self.spell[i] = chr(symbol)
        self.base, self.rules = base, {}
        self.made = [(-1, -1, -1)] * size  # rank, left and right part of the merge that makes a token
        self.twice = set()  # tokens that several merges make
        for rank, (a, b) in enumerate(model["merges"]):
            a, b, made = vocab[a], vocab[b], vocab[a + b]
            if (a, b) in self.rules:
                continue
            self.rules[a, b] = (rank, made)
            self.spell[made] = self.spell[a] + self.spell[b]
            if self.made[made][0] >= 0:
                self.twice.add(made)
            else:
                self.made[made] = (rank, a, b)
        self.length = [len(s) for s in self.spell]
        self.back = [len(s) - 1 for s in self.spell]
        self.prefix: dict[int, int] = {}
        self.tokens = ahocorasick.Automaton()
        for i, s in enumerate(self.spell):
            if s:
                self.tokens.add_word(s, i)
        self.tokens.make_automaton()

    def _offsets(self, vocab, decoder) -> None:
        """Text of token i: blob[offset[i]:offset[i + 1]]."""
        size = 1 + max([*vocab.values(), *self.added.values()])
        texts = [b""] * size
        if decoder is None:  # token strings as they are, one space between
            for s, i in [*vocab.items(), *self.added.items()]:
                texts[i] = s.encode() + b" "
            self.gap = 1
        elif decoder["type"] == "ByteLevel":
            to_byte = {c: b for b, c in enumerate(byte_chars())}
            for s, i in vocab.items():
                texts[i] = bytes(to_byte[c] for c in s)
            for s, i in self.added.items():
                texts[i] = s.encode()
            self.gap = 0
        else:
            raise ValueError(f"decoder {decoder['type']}")
        self.offset = np.r_[0, np.cumsum([len(t) for t in texts])]
        self.blob = np.frombuffer(b"".join(texts), np.uint8)

    # -- encoding

    def merged(self, ids: list[int]) -> list[int]:
        """The plain rule: merge the pair of lowest rank, leftmost first."""
        ids = list(ids)
        while len(ids) > 1:
            found = [(self.rules[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.rules]
            if not found:
                break
            rank, k = min(found)
            ids[k:k + 2] = [self.rules[ids[k], ids[k + 1]][1]]
        return ids

    def _alone(self, t: int) -> bool:
        if t not in self.whole:
            self.whole[t] = self.merged([self.base[ord(c)] for c in self.spell[t]]) == [t]
        return self.whole[t]

    def _fits(self, a: int, b: int) -> bool:
        key = a * len(self.spell) + b
        ok = self.pairs.get(key)
        if ok is None:
            if self.twice:
                symbols = [self.base[ord(c)] for c in self.spell[a] + self.spell[b]]
                ok = self.merged(symbols) == [a, b]
            else:
                ok = self._alone(a) and self._alone(b) and self._apart(a, b)
            self.pairs.put(key, ok)
        return ok

    def _apart(self, a: int, b: int) -> bool:
        """Whether no merge ever joins the two sides. Goes back in time from
        the finished tokens: the part made last is taken apart, and each two
        parts that met at the border must not have had a merge of a rank below
        those that put them into their own tokens (of equal ranks, the merge
        further left comes first)."""
        never = len(self.rules)
        until_a = until_b = never
        while True:
            rule = self.rules.get((a, b))
            if rule and rule[0] < until_a and rule[0] <= until_b:
                return False
            rank_a, _, right = self.made[a]
            rank_b, left, _ = self.made[b]
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_b >= rank_a:
                b, until_b = left, rank_b
            else:
                a, until_a = right, rank_a

    def encode_word(self, word: bytes) -> list[int]:
        """Ids of one piece that the pre-tokenizer gives, in UTF-8."""
        s = word.decode("latin-1")
        if self.suffix:
            s = s[:-1] + chr(256 + word[-1])
        n, back = len(s), self.back
        longest = [-1] * n  # the longest token that starts at each place
        for end, t in self.tokens.iter(s):
            longest[end - back[t]] = t  # a longer one comes later
        length, shorter, fits = self.length, self._shorter, self._fits
        out, dead = [], set()
        pos, t = 0, longest[0]
        while pos < n:
            while t >= 0 and (pos + length[t] in dead or not (fits(out[-1], t) if out else self._alone(t))):
                t = shorter(t)
            if t >= 0:
                out.append(t)
                pos += length[t]
                t = longest[pos] if pos < n else -1
            elif out:
                dead.add(pos)
                t = out.pop()
                pos -= length[t]
                t = shorter(t)
            else:  # no vocabulary of this kind gets here; the plain rule always ends
                return self.merged([self.base[ord(c)] for c in s])
        return out

    def _shorter(self, t: int) -> int:
        """The longest token that is a proper prefix of this one; none: -1."""
        got = self.prefix.get(t)
        if got is None:
            s = self.spell[t]
            got = -1
            for k in range(len(s) - 1, 0, -1):
                if s[:k] in self.tokens:
                    got = self.tokens.get(s[:k])
                    break
            self.prefix[t] = got
        return got

    def _plain(self, text: str) -> list[bytes]:
        if self.lower:
            # one character at a time, as the library: a final sigma is no exception
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        parts = (self.pattern if BEYOND(text) else self.narrow).findall(text)
        out = list(map(self.words.get, parts))
        if None in out:
            for k, got in enumerate(out):
                if got is None:
                    p = parts[k]
                    got = self.words.get(p)
                    if got is None:
                        got = self.words.put(p, array("I", self.encode_word(p.encode())).tobytes())
                    out[k] = got
        return out

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as uint32."""
        if self.split_added is None or not self.split_added.search(text):
            out = self._plain(text)
        else:
            out = []
            for p in self.split_added.split(text):
                out += [array("I", [self.added[p]]).tobytes()] if p in self.added else self._plain(p)
        return np.frombuffer(b"".join(out), np.uint32)

    # -- decoding

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of ``ids[bounds[k]:bounds[k + 1]]``."""
        ids = np.asarray(ids, np.int64)
        if ids.size and (ids.min() < 0 or ids.max() >= len(self.offset) - 1):
            raise ValueError("an id is outside the vocabulary")
        size = self.offset[ids + 1] - self.offset[ids]
        ends = np.r_[0, np.cumsum(size)]
        at = np.arange(ends[-1]) + np.repeat(self.offset[ids] - ends[:-1], size)
        flat = self.blob[at].tobytes()
        cut = ends[bounds].tolist()
        return [flat[a:max(a, b - self.gap)].decode("utf-8", "replace") for a, b in zip(cut, cut[1:])]


_MODELS: dict[str, Bpe] = kept(__name__, {})


def model_of(source: bytes) -> Bpe:
    """The model of a file's content, built once in each Python worker."""
    key = hashlib.sha256(source).hexdigest()
    if key not in _MODELS:
        _MODELS[key] = Bpe(source.decode())
    return _MODELS[key]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        source = f.read(MAX_MODEL_BYTES + 1)
    if len(source) > MAX_MODEL_BYTES:
        raise ValueError(f"{path}: larger than {MAX_MODEL_BYTES} bytes")
    return source


def _shared(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(read_model(path))


def encode(docs: DataFrame, path: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with ``out_col``, the ids (array<int>) of each whole text under
    the tokenizer file at ``path`` on the driver, without special tokens being
    added (their strings in a text become their ids).

    Null and empty texts give an empty array. Every other column is kept as it
    is; an existing ``out_col`` is replaced. An empty table stays empty."""
    shared = _shared(docs.sparkSession, path)
    src = docs.drop(out_col)
    at = src.columns.index(text_col)
    schema = T.StructType([*src.schema.fields, T.StructField(out_col, T.ArrayType(T.IntegerType()))])

    def run(it):
        model = model_of(shared.value)
        for b in batches(it, 4 << 20, text_col):
            parts = [model.encode(t or "") for t in b.column(at).to_pylist()]
            offsets = np.zeros(len(parts) + 1, np.int32)
            np.cumsum([len(p) for p in parts], out=offsets[1:])
            flat = np.concatenate([*parts, np.empty(0, np.uint32)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, out_col])

    return src.transform(mapped, run, schema)


def decode(frame: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``frame`` with ``out_col``, the text of the ids in ``ids_col``. Null
    arrays and empty ones give an empty text; an id outside of the vocabulary,
    or a null id, raises. Other columns stay; an existing ``out_col`` is replaced."""
    shared = _shared(frame.sparkSession, path)
    src = frame.drop(out_col).withColumn(ids_col, F.coalesce(ids_col, F.array().cast("array<int>")))
    at = src.columns.index(ids_col)
    schema = T.StructType([*src.schema.fields, T.StructField(out_col, T.StringType())])

    def run(it):
        model = model_of(shared.value)
        for big in it:
            n = np.diff(big.column(at).offsets.to_numpy())
            part = np.cumsum(n) // (1 << 20)
            cut = np.flatnonzero(np.diff(part)) + 1
            for lo, hi in zip(np.r_[0, cut], np.r_[cut, big.num_rows]):
                b = big.slice(int(lo), int(hi - lo))
                col = b.column(at)
                bounds = col.offsets.to_numpy()
                flat = col.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0]))
                if flat.null_count:
                    raise ValueError("a null id")
                texts = model.decode(flat.to_numpy(), bounds - bounds[0])
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())],
                                                 names=[*b.schema.names, out_col])

    return src.transform(mapped, run, schema)


def digests(encoded: DataFrame, path: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space),
    decoded_sha256 (of the decoded text in UTF-8), and the ids if asked for."""
    return decode(encoded.select("doc_id", "ids"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *(["ids"] if ids else []))
