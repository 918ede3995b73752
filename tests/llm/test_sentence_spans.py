import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyspark.llm import sentence_spans as module
from tallyspark.llm.sentence_spans import FACTORS, LONG_WORD, cut, remove_repeated_passages, run_ends


def plain_hash(word):
    """The cut hash of a word, by its definition."""
    size, mask = len(word), (1 << 64) - 1
    value = sum((ord(char) + 1) * pow(FACTORS[0], at, 1 << 64) for at, char in enumerate(word)) & mask
    if size >= LONG_WORD:
        value = xxhash.xxh3_64_intdigest(word.encode())
    for shift, factor in ((32, FACTORS[2]), (29, FACTORS[3])):
        value = (value ^ value >> shift) * factor & mask
    return value ^ value >> 32


def plain_pieces(text):
    """Words of each piece and whether a sentence ends with it, by the rule alone: no module code but the fixed sets."""
    words, stops = [], []
    for line in (text or "").split("\n"):
        if module._HAS_UNSPACED.search(text or ""):
            own = module._ANY_WORD.findall(line)
        else:
            own = line.split()
        words += own
        stops += [word.rstrip(module._CLOSERS).endswith(module._ENDS) for word in own]
        stops = stops[:-1] + [True] if own else stops
    out, first = [], 0
    for at, stop in enumerate(stops):
        if not stop:
            continue
        own = words[first : at + 1]
        cuts = {len(own)}
        if len(own) > 9:
            hashes = [plain_hash(word) for word in own]
            for start in range(len(own) - 4):
                window = hashes[start : start + 5]
                cuts.add(start + max(place for place, one in enumerate(window) if one == min(window)) + 1)
        begin = 0
        for end in sorted(cuts):
            out.append((own[begin:end], end == len(own)))
            begin = end
        first = at + 1
    return out


def sentences(text):
    return [words for words, _ in plain_pieces(text)]


def compare_cuts(text):
    pieces, want = cut(text), plain_pieces(text)
    spans = list(zip(pieces.starts.tolist(), pieces.ends.tolist()))
    assert ["".join(text[start:end].split()) for start, end in spans] == ["".join(words) for words, _ in want]
    assert pieces.sizes.tolist() == [len(words) for words, _ in want]
    assert pieces.whole.tolist() == [whole for _, whole in want]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .!\n\té\x1f\u2003\"”", max_size=120))
def test_cut_as_its_rule(text):
    compare_cuts(text)


def test_cut_of_long_words_and_texts():
    rng = random.Random(1)
    compare_cuts(" ".join("x" * rng.choice([1, 3, 255, 256, 400]) + rng.choice(["", "", "."]) for _ in range(300)))
    compare_cuts(" ".join(f"w{rng.randrange(9999)}" for _ in range(20_000)))
    same = cut("a b c d e f g h i j k l. Same here now.")
    assert same.hashes[-1] == cut("Other. Same here\tnow.").hashes[-1] != cut("Same here now").hashes[-1]


def brute(rows, run_sentences, run_words):
    """Sentences that stay, by comparing the words of all runs."""
    seen, gone = set(), {}
    order = sorted(range(len(rows)), key=lambda at: (rows[at][0] is not None, rows[at][0] or 0, at))
    for at in order:
        found = sentences(rows[at][1])
        gone[at] = set()
        for first in range(len(found)):
            end, words = first, 0
            while end < len(found) and (end - first < run_sentences or words < run_words):
                words += len(found[end])
                end += 1
            if end - first < run_sentences or words < run_words:
                continue
            run = tuple(word for sentence in found[first:end] for word in (*sentence, None))
            if run in seen:
                gone[at] |= set(range(first, end))
            seen.add(run)
    return gone


def test_as_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("alpha beta gamma delta".split()) + str(rng.randrange(40))
    sentence = lambda: " ".join(word() for _ in range(rng.randrange(1, 15))) + rng.choice([". ", "!\n", "? ", "\n"])
    shared = ["".join(sentence() for _ in range(rng.randrange(3, 9))) for _ in range(6)]
    rows = [
        (number, "".join(rng.choice(shared) if rng.random() < 0.3 else sentence() for _ in range(rng.randrange(1, 12))))
        for number in range(60)
    ]
    rows += [(None, None), (None, shared[0]), (None, shared[0]), (61, ""), (3, rows[3][1]), (62, "one. " * 50)]
    docs = spark.createDataFrame([(*row, 1, "k") for row in rows], "doc_id long, text string, place long, key string").coalesce(1)
    for run_sentences, run_words in ((3, 25), (2, 8)):
        want = brute(rows, run_sentences, run_words)
        cleaned = remove_repeated_passages(docs, run_sentences=run_sentences, run_words=run_words)
        assert cleaned.columns == [*docs.columns, "n_sentences", "n_removed"]
        expected = []
        for at, (key, text) in enumerate(rows):
            found = sentences(text)
            kept = [" ".join(words) for place, words in enumerate(found) if place not in want[at]]
            whole = [end for _, end in plain_pieces(text or "")]
            touched = {sum(whole[:place]) for place in want[at]}
            expected.append((key, sum(whole), len(touched), None if text is None else " ".join(kept)))
        got = [
            (row.doc_id, row.n_sentences, row.n_removed, None if row.text is None else " ".join(row.text.split()))
            for row in cleaned.collect()
        ]
        assert sorted(got, key=str) == sorted(expected, key=str)
    assert remove_repeated_passages(docs.filter(F.lit(False))).count() == 0


def test_planted_passage(spark):
    passage = " ".join(f"planted{number}" + ("." if number % 9 == 8 else "") for number in range(54))
    docs = spark.createDataFrame(
        [(number, f"Own words {number} here. {passage} And {number} more of it.") for number in range(50)],
        "doc_id long, text string",
    )
    rows = remove_repeated_passages(docs).collect()
    assert all(("planted20" in row.text) == (row.doc_id == 0) for row in rows)
    assert all(f"Own words {row.doc_id} here." in row.text for row in rows)
    assert run_ends(np.array([10, 10, 10]), 3, 25) == [3, 0, 0]


def runs(text):
    found = sentences(text)
    ends = run_ends(np.array([len(words) for words in found]), 3, 25)
    return {tuple(map(tuple, found[first:end])) for first, end in enumerate(ends) if end}


def test_repeated_words_share_a_run_wherever_they_start():
    rng = random.Random(9)
    word = lambda stops: f"w{rng.randrange(10**9)}" + ("." if rng.random() < stops else "")
    for stops in [0, 0.02, 0.05, 0.1, 0.2] * 400:
        passage = [word(stops) for _ in range(51)]
        texts = [
            " ".join([*(word(around) for _ in range(rng.randrange(40))), *passage, *(word(around) for _ in range(rng.randrange(40)))])
            for around in (rng.choice([0, 0.2]), rng.choice([0, 0.2]))
        ]
        assert runs(texts[0]) & runs(texts[1])


def test_passage_without_stops_at_different_offsets(spark):
    passage = " ".join(f"planted{number}" for number in range(60))
    docs = spark.createDataFrame(
        [(number, " ".join(f"own{number}x{at}" for at in range(number)) + f" {passage} more{number}") for number in range(30)],
        "doc_id long, text string",
    )
    rows = remove_repeated_passages(docs).collect()
    assert all(("planted30" in row.text) == (row.doc_id == 0) for row in rows)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .!\n\"”」「。你好กำ가。", max_size=80))
def test_two_ways_to_cut_without_spaces(text):
    compare_cuts(text)


def test_marks_before_closers_and_letters_as_words():
    assert [" ".join(words) for words in sentences('He said "no." (Yes!) So')] == ['He said "no."', "(Yes!)", "So"]
    assert sentences("你好。「是!」abc") == [["你", "好。"], ["「是!」"], ["abc"]]


def test_passages_in_scripts_without_spaces(spark):
    rng = random.Random(3)
    for low, high in ((0x4E00, 0x9FFF), (0x3041, 0x3096), (0x0E01, 0x0E2E)):
        letters = lambda count, low=low, high=high: "".join(chr(rng.randrange(low, high)) for _ in range(count))
        passage = letters(60)
        docs = spark.createDataFrame(
            [(number, letters(number + 5) + passage + letters(12)) for number in range(20)], "doc_id long, text string"
        )
        rows = remove_repeated_passages(docs).collect()
        assert all((passage[20:40] in row.text) == (row.doc_id == 0) for row in rows)
