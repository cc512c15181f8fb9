"""Token ids of whole texts by the tokenizers library, with distinct words encoded once.

A text is cut at Unicode white space, where this tokenizer never joins anything: its
pattern matches no white space and canonical composition does not cross it. Distinct
words of a batch come from Arrow's dictionary encoding, distinct pieces of words go
through the library, and the ids are gathered back with array operations. Only words of
ASCII and Latin-1 letters are cut into pieces here; any other word goes through the
library whole, so normalisation is always the library's own.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.llm.common import column, give_back, large_store, steps, worker_store

TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Words a worker remembers; beyond it those that were not met again are forgotten.
CACHE_WORDS = 500_000
#: Pieces of words a worker remembers; beyond it they start anew.
CACHE_PIECES = 400_000

#: White space of the library's pattern (Unicode White_Space), as fixed values.
SPACES = "\t-\r \x85\xa0  -     　"
#: Information separators count as white space for Arrow and Python, not for the tokenizer.
SEPARATORS = "[\x1c-\x1f]"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class Encoder:
    """``ids(texts)``: ids of all texts, end to end, and the number of ids of each text."""

    def __init__(self, path: str):
        import os

        from tokenizers import Tokenizer, pre_tokenizers
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.load = lambda: Tokenizer.from_file(path)
        self._whole = None
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer, self.pieces.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
        size = self.pieces.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(size, dtype=bool)
        for token, i in self.pieces.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        # Bytes outside the printable ranges are written as the code points from 256 on.
        odd = itertools.count(256)
        self.alphabet = [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(odd)) for b in range(256)]
        self.plain = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
        self.special = re.compile("<\\|(?:startoftext|endoftext)\\|>").search
        self.cut = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+").findall
        self.split = re.compile(f"[^{SPACES}]+").findall
        self.odd = re.compile(SEPARATORS).search
        #: A word's code points into ``first`` and ``size``, which point into ``flat``; ``met`` is the step it was last in.
        self.by_word: dict[str, int] = {"": 0}
        self.by_piece: dict[str, tuple[int, ...]] = {}
        self.flat, self.first, self.size = np.empty(0, dtype=np.int32), np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.met, self.again, self.step = np.zeros(1, dtype=np.int32), np.zeros(1, dtype=bool), 0

    @property
    def whole(self):
        """The tokenizer as it is, for words that are not cut here; most corpora need it, some tasks do not."""
        if self._whole is None:
            self._whole = self.load()
        return self._whole

    def _forget(self, room: int) -> None:
        """Make room: words of this step stay, then those met in two steps or more, the latest first."""
        order = np.lexsort((self.met, self.again, self.met == self.step))
        keep = np.zeros(len(self.met), dtype=bool)
        keep[order[max(0, len(order) - max(CACHE_WORDS // 2, int((self.met == self.step).sum()), CACHE_WORDS - room)):]] = True
        keep &= self.again | (self.met == self.step)
        keep[0] = True
        code = np.cumsum(keep) - 1
        self.by_word = {w: int(code[c]) for w, c in self.by_word.items() if keep[c]}
        size = self.size[keep]
        starts = np.cumsum(size) - size
        self.flat = self.flat[np.arange(int(size.sum())) + np.repeat(self.first[keep] - starts, size)]
        self.first, self.size, self.met, self.again = starts, size, self.met[keep], self.again[keep]
        if len(self.by_piece) > CACHE_PIECES:
            self.by_piece.clear()

    def _learn(self, words: list[str]) -> None:
        cut, whole = {}, []
        for w in words:
            # Most words are ASCII letters, perhaps with a mark: their pieces need no pattern.
            if w.isascii() and w.isalpha():
                cut[w] = (w.lower(),)
            elif w.isascii() and w[:-1].isalpha() and w[-1] in ".,;:!?":
                cut[w] = (w[:-1].lower(), w[-1])
            elif self.plain(w) and not ("<" in w and self.special(w)):
                cut[w] = self.cut(w.lower())
            else:
                whole.append(w)
        get, alphabet = self.by_piece, self.alphabet
        new = [p for p in dict.fromkeys(itertools.chain.from_iterable(cut.values())) if p not in get]
        for at in range(0, len(new), 20_000):
            part = new[at:at + 20_000]
            line = [p if p.isascii() else "".join(map(alphabet.__getitem__, p.encode())) for p in part]
            coded = self.pieces.encode_batch_fast([" ".join(line[i:i + 500]) for i in range(0, len(line), 500)], add_special_tokens=False)
            ids = list(itertools.chain.from_iterable(e.ids for e in coded))
            stops = (np.flatnonzero(self.ends[np.array(ids, dtype=np.int64)]) + 1).tolist()
            if len(stops) != len(part):
                raise ValueError("pieces and ids do not match")
            before = 0
            for p, stop in zip(part, stops):
                get[p] = tuple(ids[before:stop])
                before = stop
        of = [get[ps[0]] if len(ps) == 1 else tuple(itertools.chain.from_iterable(get[p] for p in ps)) for ps in cut.values()]
        if whole:
            of += [tuple(e.ids) for e in self.whole.encode_batch(whole, add_special_tokens=False)]
        size = np.fromiter(map(len, of), dtype=np.int64, count=len(of))
        flat = np.fromiter(itertools.chain.from_iterable(of), dtype=np.int32, count=int(size.sum()))
        self.by_word.update(zip([*cut, *whole], range(len(self.size), len(self.size) + len(of))))
        self.first = np.concatenate((self.first, len(self.flat) + np.cumsum(size) - size))
        self.size = np.concatenate((self.size, size))
        self.flat = np.concatenate((self.flat, flat))
        self.met = np.concatenate((self.met, np.full(len(size), self.step, dtype=np.int32)))
        self.again = np.concatenate((self.again, np.zeros(len(size), dtype=bool)))

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        lower = pc.ascii_lower(texts)
        if not pc.any(pc.match_substring_regex(lower, "<\\|(?:startoftext|endoftext)\\|>")).as_py():
            texts = lower  # ASCII letters fold alone; the special strings exist in lower case only
        if pc.any(pc.match_substring_regex(texts, SEPARATORS)).as_py():
            lists = pa.array([self.split(t) for t in texts.to_pylist()], type=pa.list_(pa.string()))
        else:
            lists = pc.utf8_split_whitespace(texts)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        del texts, lower
        coded = lists.flatten()
        del lists
        coded = coded.dictionary_encode()
        words, index = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        del coded
        self.step += 1
        codes = list(map(self.by_word.get, words))
        known = np.array([c for c in codes if c is not None], dtype=np.int64)
        self.again[known], self.met[known] = True, self.step
        if len(known) < len(codes):
            missing = [w for w, c in zip(words, codes) if c is None]
            if len(self.by_word) + len(missing) > CACHE_WORDS:
                self._forget(len(missing))
            self._learn(missing)
            codes = list(map(self.by_word.__getitem__, words))
        del words
        code = np.array(codes, dtype=np.int32)[index]
        del codes, index
        sizes = self.size[code]
        before = np.concatenate(([0], np.cumsum(sizes)))
        # Places in 32 bits where they fit, which all but a single text of gigabytes do.
        kind = np.int32 if max(int(before[-1]), len(self.flat)) < 1 << 31 else np.int64
        place = np.repeat((self.first[code] - before[:-1]).astype(kind), sizes)
        del code, sizes
        place += np.arange(before[-1], dtype=kind)
        return self.flat[place], np.diff(before[np.concatenate(([0], np.cumsum(counts)))])


def encoder(path: str) -> Encoder:
    """The worker's encoder for this vocabulary file."""
    store = large_store("encoders")
    if path not in store:
        store[path] = Encoder(path)
    return store[path]


def with_end(ids: np.ndarray, lengths: np.ndarray, end: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Each document followed by its end id."""
    stops = np.cumsum(lengths)
    return np.insert(ids, stops, end), lengths + 1


def slices(ids: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    for n in lengths.tolist():
        yield ids[at:at + n]
        at += n


TOKEN_TABLE = "doc_id bigint, n_ids bigint, ids binary"
#: Bytes of text encoded at a time: large enough that most words of a step repeat.
ENCODE_BYTES = 12 << 20


def pack_ids(ids: np.ndarray, pack=None) -> bytes:
    return (pack or zstandard.ZstdCompressor(level=1).compress)(ids.astype("<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4").tobytes())


def unpack_ids(packed: bytes, n: int) -> np.ndarray:
    store = worker_store("unpack")
    if "one" not in store:  # a context costs more than most texts
        store["one"] = zstandard.ZstdDecompressor()
    raw = store["one"].decompress(packed)
    return np.frombuffer(raw, dtype="<u2" if len(raw) == 2 * n else "<u4")


def token_table(docs: DataFrame, tokenizer: str | None = None, end: int = END_ID) -> DataFrame:
    """One row per document: its ids with the end id, compressed, and their number. A null text is empty."""
    path = tokenizer or tokenizer_path()

    def run(batches):
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in steps(batches, limit=ENCODE_BYTES):
            ids, lengths = encoder(path).ids(column(batch, "text"))
            ids, lengths = with_end(ids, lengths, end)
            give_back()
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(lengths), pa.array([pack_ids(x, pack) for x in slices(ids, lengths)], type=pa.binary())],
                                             names=["doc_id", "n_ids", "ids"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, TOKEN_TABLE)
