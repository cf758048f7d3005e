"""Quality rules against a brute-force version with strings."""

import random
import re
from collections import Counter

from greenledger.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, words))

    def inside(k):
        grams = Counter(tuple(words[i:i + k]) for i in range(n - k + 1))
        return {j for i in range(n - k + 1) if grams[tuple(words[i:i + k])] > 1 for j in range(i, i + k)}

    repeat = max((sum(len(words[j]) for j in inside(k)) for k in q.REPEAT_LIMITS), default=0)
    return {"n_words": n, "word_chars": chars, "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": sum(lines[i] in lines[:i] for i in range(len(lines))),
            "n_repeat_words": len(inside(5)), "repeat_chars": repeat,
            "base_failed": n < 10 or 100 * len(inside(5)) > 20 * n}


def cases():
    rng = random.Random(5)
    made = [" ".join(rng.choice("the of and a in to x y z".split()) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    made += ["\n".join(rng.choice(["one two three", " \t ", "", "a b c d e f g"]) for _ in range(12)) for _ in range(20)]
    return made + ["", "   x", "a\x0bb\x0cc", "#*$%&|<> # *", "same line\nsame line", "w " * 5000]


def test_measures_are_those_of_the_brute_force(small):
    for text in cases() + [r.text for r in small("documents", "/root/testdata/sf0.001").collect()]:
        found = q.measure(text)
        assert {k: found[k] for k in brute(text)} == brute(text), text[:80]
        assert not (found["base_failed"] and found["kept"])


def test_repetition_fails_and_prose_stays():
    rng = random.Random(1)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    prose = " ".join(words)
    assert q.measure(prose)["kept"]
    assert not q.measure("buy now " * 40)["kept"]
    assert not q.measure(" ".join(words[:30] * 4))["kept"]
    assert not q.measure(prose.upper())["kept"]
    assert not q.measure(" | ".join(words[:50]))["kept"]
    assert q.measure(prose + "\n" + " ".join(words[:12]))["kept"]


def test_capitals_are_counted_and_scripts_without_case_stay():
    rng = random.Random(2)

    def prose(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(300))

    for letters in ("ابتثجحخدذرزسشصضطظعغ", "אבגדהוזחטיכלמנסעפצקרשת", "कखगघचछजझटठडढणतथदधन", "가나다라마바사아자차카타파하", "あいうえおかきくけこさしすせそ"):
        assert q.measure(prose(letters))["kept"], letters
    text = prose("aeioulnrst")
    assert not q.measure(text.upper() + " a")["kept"]
    assert not q.measure("".join(c if i % 5 > 1 else c.lower() for i, c in enumerate(text.upper())))["kept"]
    assert q.measure("".join(c if i % 5 > 2 else c.lower() for i, c in enumerate(text.upper())))["kept"]


def test_labelled_rows(small):
    rows = small("documents").join(small("labels"), "doc_id").collect()
    kept = {r.doc_id: q.measure(r.text)["kept"] for r in rows}
    good = [kept[r.doc_id] for r in rows if r.quality == 1 and len(r.text.split()) >= 10]
    bad = [kept[r.doc_id] for r in rows if r.quality == 0]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_spark_rows(documents):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x " * 30), (3, "x " * 30)]
    got = q.quality_rules(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [
        (0, 2, False), (1, 0, False), (2, 0, False), (3, 30, False), (3, 30, False)]
    assert all(r.base_failed for r in got)
    assert q.quality_rules(documents([])).collect() == []
