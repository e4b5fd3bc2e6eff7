"""Fingerprints against exact similarity, and the edited texts."""

import re
import statistics

import xxhash

from towerlens.llm import minhash


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def test_edits_and_likeness(documents, odd_texts, prose):
    long = [" ".join(f"{stem}{i * i % 997}" for i in range(700)) for stem in ("a", "a", "b")]
    texts = odd_texts + prose + long
    found = {r.doc_id: r for r in minhash.edited_likeness(documents(texts, start=5)).collect()}
    plain = [text or "" for text in texts]
    errors, prints = [], {}
    for place, text in enumerate(plain):
        row, after = found[place + 5], plain[(place + 1) % len(plain)]
        half = len(text) // 2
        assert row.n_chars == len(text) and row.edited == text[: len(text) - half] + after[:half]
        errors += [row.near_edited - jaccard(text, row.edited), row.near_next - jaccard(text, after)]
        prints.setdefault(text, set()).add(row.fingerprint)
        prints.setdefault(row.edited, set()).add(row.edited_fingerprint)
    assert len(found) == len(texts)
    assert all(len(same) == 1 for same in prints.values())
    assert abs(statistics.mean(errors)) < 0.02 and statistics.mean(e * e for e in errors) ** 0.5 < 0.06


def plain_print(text):
    """Bins and densification rebuilt one by one."""

    def signed(value):
        return value - (1 << 64) if value >> 63 else value

    def chained(*numbers):
        value = 42
        for number in numbers:
            value = xxhash.xxh64_intdigest(number.to_bytes(4, "little"), value)
        return value

    words = [word.encode() for word in re.findall(r"[^\x20\x09-\x0D]+", text)]
    least = {}
    for at in range(max(1, len(words) - minhash.SHINGLE + 1)):
        value = 42
        for word in words[at : at + minhash.SHINGLE]:
            value = xxhash.xxh64_intdigest(word, value)
        value = signed(value)
        number = (value >> (64 - minhash.BIN_BITS)) + minhash.BINS // 2
        least[number] = min(least.get(number, value), value)
    out = []
    for own in range(minhash.BINS):
        walk = [own, *[signed(chained(minhash.SEED, step, own)) % minhash.BINS for step in range(minhash.STEPS)]]
        filled = next((number for number in walk if number in least), None)
        if filled is None:
            filled = min(least, key=lambda number: signed(chained(minhash.SEED, number, own)))
        out.append(f"{least[filled] & 255:02x}")
    return "".join(out)


def test_equals_a_plain_version(documents, odd_texts, prose):
    texts = odd_texts + prose + [" ".join(f"t{n * n % 1009}" for n in range(2500)), "one two three four five six seven"]
    for row in minhash.fingerprints(documents(texts)).collect():
        assert row.fingerprint == plain_print(texts[row.doc_id] or ""), texts[row.doc_id]


def test_fingerprints_are_the_same_alone(documents, prose):
    docs = documents(prose[:20])
    alone = {r.doc_id: r.fingerprint for r in minhash.fingerprints(docs).collect()}
    assert alone == {r.doc_id: r.fingerprint for r in minhash.edited_likeness(docs).collect()}


def test_order_of_nulls_ties_and_few_rows(spark, documents):
    docs = spark.createDataFrame([(3, "ccc"), (None, "nn"), (1, "bb"), (1, "aa"), (1, "aa")], "doc_id long, text string")
    found = sorted(((r.doc_id is None, r.doc_id, r.edited) for r in minhash.edited_likeness(docs).collect()), key=str)
    assert found == [(False, 1, "aa"), (False, 1, "ab"), (False, 1, "bc"), (False, 3, "ccn"), (True, None, "na")]
    one = minhash.edited_likeness(documents(["abcd"])).first()
    assert one.edited == "abab" and one.near_next == 1
    assert minhash.edited_likeness(documents([])).count() == 0


def test_no_python_in_tasks(documents, prose):
    plan = minhash.edited_likeness(documents(prose))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
