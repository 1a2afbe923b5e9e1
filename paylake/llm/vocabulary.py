"""Public tokenizer files, read inside tasks by name."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from paylake.llm import arrow
from paylake.llm.memo import Memo

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"
# Text encoded at once: the more, the fewer distinct chunks there are to encode.
SLICE_BYTES = 8 << 20


def vocabulary_path(name: str) -> str:
    """A path as given, or the installed file of that name."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of whole texts as the tokenizers library gives them, with each distinct chunk encoded once.

    A chunk ends at ASCII white space, or between an ASCII letter and a punctuation mark
    of ``MARKS``. The pre-tokenizer always separates there, so the ids of a text are the ids of its
    chunks in order. ASCII letters are lower-cased first, as the normalizer does later. Texts
    that may hold a special token are encoded whole.
    """

    MARKS = ".,!*&%$#?;:"
    # A chunk of letters is one word, whose last id alone bears the end mark. Many such chunks
    # are encoded as one text and told apart by it, which the library does faster.
    PLAIN = "^[a-zß-öø-ÿ]+$"
    WORD_END = "</w>"
    TOGETHER = 512
    # Other chunks given to the library at once.
    AT_ONCE = 4096
    # Chunks whose ids are kept from slice to slice and from task to task, those seen last, as
    # two flat Arrow arrays: some MB. Chunks of more bytes are not kept.
    KEPT = 200_000
    KEPT_BYTES = 64

    def __init__(self, name: str = WORDS):
        # Spark runs a worker per core; the library's own threads would only compete.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(vocabulary_path(name))
        self.special = sorted(
            token.content for token in self.library.get_added_tokens_decoder().values()
        )
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        for token, number in self.library.get_vocab().items():
            self.ends_word[number] = token.endswith(self.WORD_END)
        self.kept = pa.array([], pa.string())
        self.kept_ids = pa.array([], pa.large_binary())

    def _library(self, strings: list[str]) -> list[np.ndarray]:
        encoded = self.library.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(each.ids, "<u4") for each in encoded]

    def _encode(self, chunks: pa.Array) -> pa.Array:
        """The library's ids of each chunk, as bytes."""
        plain = pc.match_substring_regex(chunks, self.PLAIN).to_numpy(zero_copy_only=False)
        at = np.flatnonzero(plain)
        begins = np.arange(0, len(at), self.TOGETHER)
        words = pa.ListArray.from_arrays(
            pa.array(np.append(begins, len(at)), pa.int32()), chunks.take(pa.array(at))
        )
        order, sizes, ids = [], [], []
        for begin, text in zip(begins, pc.binary_join(words, " ").to_pylist(), strict=True):
            part = at[begin : begin + self.TOGETHER]
            (found,) = self._library([text])
            stops = np.flatnonzero(self.ends_word[found]) + 1
            if len(stops) == len(part):
                order.append(part)
                sizes.append(np.diff(stops, prepend=0))
                ids.append(found[: stops[-1]])
            else:
                plain[part] = False
        rest = np.flatnonzero(~plain)
        for begin in range(0, len(rest), self.AT_ONCE):
            part = rest[begin : begin + self.AT_ONCE]
            found = self._library(chunks.take(pa.array(part)).to_pylist())
            order.append(part)
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            ids.extend(found)
        if not order:
            return pa.array([], pa.large_binary())
        places = np.zeros(len(chunks) + 1, np.int64)
        np.cumsum(np.concatenate(sizes) * 4, out=places[1:])
        buffers = [None, pa.py_buffer(places), pa.py_buffer(np.concatenate(ids))]
        by_order = pa.Array.from_buffers(pa.large_binary(), len(chunks), buffers)
        return by_order.take(pa.array(np.argsort(np.concatenate(order))))

    def ids_of(self, chunks: pa.Array) -> pa.Array:
        """Ids of distinct chunks as bytes; only those that are not kept go to the library."""
        chunks = chunks.cast(self.kept.type)
        at = pc.index_in(chunks, value_set=self.kept)
        new = pc.is_null(at).to_numpy(zero_copy_only=False)
        row = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        older = np.ones(len(self.kept), bool)
        older[row[~new]] = False
        row[new] = len(self.kept) + np.arange(new.sum())
        found = pa.concat_arrays([self.kept_ids, self._encode(chunks.filter(pa.array(new)))])
        ids = found.take(pa.array(row))
        short = pc.less_equal(pc.binary_length(chunks), self.KEPT_BYTES)
        self.kept, self.kept_ids = (
            self._seen_last(*arrays, short, pa.array(older))
            for arrays in ((chunks, self.kept), (ids, self.kept_ids))
        )
        return ids

    def _seen_last(self, now: pa.Array, before: pa.Array, short: pa.Array, older: pa.Array) -> pa.Array:
        now = now.filter(short).slice(0, self.KEPT)
        return pa.concat_arrays([now, before.filter(older).slice(0, self.KEPT - len(now))])

    def encode(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row as unsigned 32-bit, and the number of ids of each text."""
        whole = np.zeros(len(strings), bool)
        for special in self.special:
            whole |= pc.match_substring(strings, special, ignore_case=True).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(whole), "", strings) if whole.any() else strings
        spaced = pc.replace_substring_regex(
            pc.ascii_lower(plain), f"([a-z])([{self.MARKS}])", r"\1 \2"
        )
        words = pc.ascii_split_whitespace(spaced)
        del spaced, plain
        n_words = pc.list_value_length(words).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        del words
        flat, places = arrow.raw_bytes(self.ids_of(coded.dictionary).take(coded.indices))
        out = flat.view("<u4")
        word_ends = np.cumsum(n_words)
        counts = (places[word_ends] - places[word_ends - n_words]) // 4
        if whole.any():
            return self._with_whole(strings, whole, out, counts)
        return out, counts

    def _with_whole(self, strings, whole, out, counts):
        pieces = np.split(out, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(whole):
            encoded = self.library.encode(strings[int(i)].as_py(), add_special_tokens=False)
            pieces[i] = np.array(encoded.ids, "<u4")
        return np.concatenate(pieces), np.array([len(piece) for piece in pieces], np.int64)


class PieceCounter:
    """Number of pieces of whole texts as the sentencepiece library gives it.

    Pre-tokens start at a run of blanks, at a line end, and at a stop or comma behind an ASCII
    letter. No piece of the vocabulary spans such a place (checked when the file is
    read), so merges never cross it and counts add up. Each distinct pre-token is counted once.
    """

    BLANK = "▁"

    def __init__(self, name: str = PIECES):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(name))
        probe = "".join(self.library.encode("  a\n ", out_type=str))
        if probe != f"{self.BLANK * 3}a<0x0A>{self.BLANK}":
            raise ValueError(f"{name} drops blanks or has no byte pieces")
        pieces = pa.array(self.library.id_to_piece(list(range(self.library.get_piece_size()))))
        crossing = pc.match_substring_regex(pieces, f"[^{self.BLANK}]{self.BLANK}|\n|[a-z][.,]")
        if pc.any(crossing).as_py():
            raise ValueError(f"pieces of {name} span the places where pre-tokens start")
        self.memo = Memo(self._count)

    def _count(self, tokens: list[str]) -> list[int]:
        # The library puts a blank before a text. A pre-token with a blank in front lends its
        # own; before any other goes a line end, and the blank and the line end are taken off.
        led = [token.startswith(self.BLANK) for token in tokens]
        asked = [token[1:] if ok else "\n" + token for token, ok in zip(tokens, led, strict=True)]
        encoded = self.library.encode(asked, num_threads=1)
        return [
            (len(ids) or 1) - (0 if ok else 2) for ids, ok in zip(encoded, led, strict=True)
        ]

    def count(self, strings: pa.Array) -> np.ndarray:
        """Pieces of each text: pre-token frequencies joined with pieces per distinct pre-token."""
        cut = "\x00"
        whole = pc.match_substring(strings, cut).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(whole), "", strings) if whole.any() else strings
        blanks = pc.replace_substring(plain, " ", self.BLANK)
        marked = pc.binary_join_element_wise(self.BLANK, blanks, "")
        marked = pc.replace_substring_regex(marked, f"({self.BLANK}+|\n)", f"{cut}\\1")
        marked = pc.replace_substring_regex(marked, "([a-z])([.,])", f"\\1{cut}\\2")
        tokens = pc.split_pattern(marked, cut)
        n_tokens = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        rows = np.repeat(np.arange(len(strings)), n_tokens)
        # Frequency of each (document, pre-token), then one look-up per distinct pre-token.
        pieces = np.zeros(len(names), np.int64)
        known = [i for i, name in enumerate(names) if name]
        pieces[known] = self.memo.get([names[i] for i in known])
        weights = pieces[coded.indices.to_numpy()]
        counts = np.bincount(rows, weights, minlength=len(strings)).astype(np.int64)
        empty = pc.equal(strings, "").to_numpy(zero_copy_only=False)
        counts[empty] = 0
        for i in np.flatnonzero(whole):
            counts[i] = len(self.library.encode(strings[int(i)].as_py()))
        return counts


@lru_cache(maxsize=4)
def word_encoder(name: str = WORDS) -> WordEncoder:
    return WordEncoder(name)


@lru_cache(maxsize=4)
def piece_counter(name: str = PIECES) -> PieceCounter:
    return PieceCounter(name)
