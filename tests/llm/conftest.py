import random

import pytest


@pytest.fixture
def documents(spark):
    """A documents table from texts; ids are their places."""

    def made(texts, start=0):
        rows = [(start + place, text, "en", "s", len(text or "")) for place, text in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return made


ODD = [
    None,
    "",
    " ",
    "a",
    "a ",
    "  A b\tc\x0bd\x0ce\rf\x1cg\x85h　i\xa0j",
    "x y z",
    "X Y Z",
    "x y z",
    "word " * 3000,
    "\n\n\n",
    "%%% &&& ###",
    "Straße İstanbul ΣΑΣ é ́",
    "日本語 😀👩‍👩‍👧 \x00 </s> <|endoftext|> <0x0A> ▁a ▁ b▁",
    "don't I'LL we're 12345 a-b_c",
]


@pytest.fixture
def odd_texts():
    """Nulls, empty and white texts, odd characters, case, repeats, a long text."""
    return list(ODD)


@pytest.fixture
def prose():
    """Random texts over few words that share passages and copies."""
    chance = random.Random(7)
    words = [f"w{n}" for n in range(40)]
    common = [chance.choice(words) for _ in range(300)]

    def text():
        out, size = [], chance.randint(0, 220)
        while len(out) < size:
            if chance.random() < 0.5:
                out += [chance.choice(words) for _ in range(chance.randint(1, 30))]
            else:
                at = chance.randint(0, 250)
                out += common[at : at + chance.randint(10, 70)]
        return " ".join(out)

    texts = [text() for _ in range(120)]
    return texts + texts[:5]
