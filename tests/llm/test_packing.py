import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from regista.llm import packing


@pytest.fixture(scope="module")
def model():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


def plain(model, text):
    """The contract's call."""
    return model.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer(model, awkward_rows):
    texts = [t or "" for _, t in awkward_rows] + [" a", "a ", "a \n b", "a\n\n b c", "  x", "it's 12 %%% ok", "a\n  b", "  x y"]
    texts += ["a <|endoftext|> b", "<|endoftext|>", "  <|endoftext|>\n<|endoftext|>x", "<|endoftext", "日本語 текст ʼn ﬁ \U0001F600"]
    encode = packing._Encoder(packing.TOKENIZER)
    assert encode.merging is not None
    for text in texts:
        assert encode(text).tolist() == plain(model, text)
    assert encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


@pytest.mark.parametrize("text", [" " * 300_000 + "x", "\n" * 300_000, "ab" * 200_000, "." * 100_000, "é 1" * 100_000], ids=range(5))
def test_stretches_of_one_kind(model, text):
    assert packing._Encoder(packing.TOKENIZER)(text).tolist() == plain(model, text)


def test_characters_of_all_planes(model):
    encode = packing._Encoder(packing.TOKENIZER)
    for first in [*range(0, 0x3100, 64), *range(0x3100, 0x110000, 64 * 61)]:
        text = "".join(f"a{c}b {c}1{c} {c}{c}'s{c} \t {c}\n" for c in map(chr, range(first, min(first + 64, 0x110000))) if not "\ud800" <= c <= "\udfff")
        assert encode(text).tolist() == plain(model, text)


def test_a_file_of_another_kind_is_left_to_the_tokenizer():
    assert packing._merging(str(public_tokenizers.path("word_bpe_49k.json"))) is None


_SPACES = [c for c in map(chr, range(0x3100)) if c.isspace() or c in "\u180e\u200b"]


@pytest.mark.parametrize("space", _SPACES, ids=[f"{ord(c):04x}" for c in _SPACES])
def test_white_space_of_any_kind_is_joined_as_the_tokenizer_joins_it(model, space):
    encode = packing._Encoder(packing.TOKENIZER)
    forms = ["a{0} {0} b", "a {0} {0} b", "a{0} b", "a {0}b", "a {0} ", "{0} {0} {0} {0} b", " {0}{0} b {0} {0} {0} {0}.", "a{0} ", "  {0}  b's {0} 1"]
    texts = [f.format(s) for f in forms for s in (space, space * 2, space + "\u00a0", "\n" + space)]
    assert [encode(t).tolist() for t in texts] == [plain(model, t) for t in texts]


@pytest.mark.parametrize("capacity", [16, 2048])
def test_every_piece_is_packed_whole(frame, model, awkward_rows, capacity):
    got = packing.pack_documents(frame(awkward_rows, clash=True), capacity).collect()
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for doc, text in awkward_rows:
        ids = np.asarray(model.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        cuts = packing._cuts(len(ids), capacity)
        assert all(e - s == capacity for s, e in cuts[1:])
        want += [(doc, i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in enumerate(cuts)]
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)


def test_empty_table(frame):
    assert packing.pack_documents(frame([])).count() == 0


def test_each_placement_makes_the_squares_smallest():
    rng = np.random.default_rng(5)
    capacity, lengths = 20, rng.integers(1, 20, 300)
    at, _ = packing.sum_of_squares(lengths, capacity)
    gaps: dict[int, int] = {}

    def squares(state):
        count = np.bincount([g for g in state.values() if g], minlength=capacity + 1)
        return int((count ** 2).sum())

    for bin_, length in zip(at.tolist(), lengths.tolist()):
        choices = [{**gaps, b: g - length} for b, g in gaps.items() if g >= length] + [{**gaps, len(gaps): capacity - length}]
        new = {**gaps, bin_: gaps.get(bin_, capacity) - length}
        assert squares(new) == min(map(squares, choices))
        gaps = new


def test_few_sequences_more_than_the_tokens_fill():
    lengths = np.minimum(np.random.default_rng(6).lognormal(6, 1, 20000).astype(int) + 1, 2047)
    at, offset = packing._fewest(lengths, 2048)
    assert at.max() + 1 <= 1.02 * lengths.sum() / 2048
    assert ((offset + lengths) <= 2048).all()
