import random
import re

from linkgraph.llm import spans as S
from tests.llm.cases import TEXTS, documents, empty


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def prose(rnd, n):
    return " ".join(words(rnd, rnd.randrange(3, 14)).capitalize() + "." for _ in range(n))


def test_sentences_cover_the_text():
    rnd = random.Random(1)
    for t in ["", "a", "One. Two! Three?\nFour", words(rnd, 500), prose(rnd, 50), "。あ。い", "\n\n x. \n"]:
        parts = S.sentences(t)
        assert "".join(t[i:j] for i, j in parts) == t


def test_passage_is_kept_once_and_clean_text_stays(spark):
    rnd = random.Random(2)
    passage = prose(rnd, 9)
    flat = words(rnd, 120)  # no punctuation at all
    rows = [(i, prose(rnd, 12) + " " + passage + " " + prose(rnd, 12), "en", "a") for i in range(30)]
    rows += [(100 + i, prose(rnd, 5) + " " + flat + " " + prose(rnd, 5), "en", "a") for i in range(3)]
    rows += [(200 + i, prose(rnd, 20), "en", "a") for i in range(20)]
    got = {r.doc_id: (r.text, r.n_removed) for r in S.dedup(documents(spark, rows)).collect()}
    before = {i: t for i, t, *_ in rows}
    assert [i for i in range(30) if passage in got[i][0]] == [0]
    assert all(got[i][0] == before[i].replace(passage + " ", "") for i in range(1, 30))
    middle = " ".join(flat.split()[30:90])
    assert [i for i in range(100, 103) if middle in got[i][0]] == [100]
    assert all(got[i] == (before[i], 0) for i in range(200, 220))


def test_against_brute_force(spark):
    rnd = random.Random(3)
    pool = [words(rnd, rnd.randrange(1, 12)) + "." for _ in range(12)]
    rows = [(i, " ".join(rnd.choice(pool) for _ in range(rnd.randrange(30))), "en", "a") for i in range(60)]
    first, covered = {}, {}
    for i, t, *_ in rows:
        for h, a, b in S.spans(t):
            if h in first:
                covered.setdefault(i, []).append((a, b))
            first.setdefault(h, i)
    got = {r.doc_id: r.text for r in S.dedup(documents(spark, rows)).collect()}
    assert got == {i: S.cut(t, covered.get(i, []))[0] for i, t, *_ in rows}
    assert covered


def test_awkward_rows(spark):
    d = documents(spark)
    got = S.dedup(d)
    assert sorted(got.columns) == sorted(d.columns) and got.count() == len(TEXTS)
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r)
    assert by[3][0].text is None and by[4][0].text == "" and len(by[2]) == 2
    assert by[2][0].row == "x"
    assert S.dedup(empty(spark)).count() == 0


def shared(one, two):
    """How many characters of the second text are in spans that the first one has."""
    known = {h for h, *_ in S.spans(one)}
    return len(two) - len(S.cut(two, [(i, j) for h, i, j in S.spans(two) if h in known])[0])


def test_every_passage_of_50_words_is_found_inside_other_text():
    rnd = random.Random(4)
    for k in range(300):
        n = 50 + k % 12
        passage = words(rnd, n).split()
        for at in [[], [18, 36], [26], sorted(rnd.sample(range(n), 3))][k % 4]:
            passage[at - 1] += "."
        one, two = (f"{words(rnd, rnd.randrange(1, 40))} {' '.join(passage)} {words(rnd, rnd.randrange(1, 40))}" for _ in range(2))
        assert shared(one, two) >= 25 * 7, k


def test_unspaced_scripts_and_long_runs():
    rnd = random.Random(5)
    for signs, n, least in [([chr(0x4e00 + i) for i in range(3000)], 110, 50), ([chr(0xe01 + i) for i in range(40)], 110, 50),
                            (list("abcdefghijklmnopqrstuvwxyz0123456789"), 330, 150)]:
        for _ in range(60):
            make = lambda k: "".join(rnd.choices(signs, k=k))
            passage = make(n)
            one, two = (make(rnd.randrange(60, 120)) + passage + make(rnd.randrange(60, 120)) for _ in range(2))
            assert shared(one, two) >= least
            assert shared(one, make(300)) == 0
    text = "。".join("".join(rnd.choices([chr(0x4e00 + i) for i in range(3000)], k=15)) for _ in range(6)) + "。"
    assert shared(text, text) == len(text)


def plain_dedup(rows, least=25):
    """Brute force over strings: short sentences split by a pattern, all runs of them compared as tuples of words."""
    seen, out = set(), {}
    for i, t in rows:
        parts = re.findall(r"[^.!?]*[.!?]+\"?\s*|[^.!?]+$", t)
        size = [len(p.split()) for p in parts]
        runs = set()
        for a in range(len(parts)):
            runs |= {next(((a, b) for b in range(a + 1, len(parts) + 1) if sum(size[a:b]) >= least), None)}
            runs |= {next(((b, a + 1) for b in range(a, -1, -1) if sum(size[b:a + 1]) >= least), None)}
        gone, own = set(), set()
        for a, b in sorted(runs - {None}):
            words = tuple(" ".join(parts[a:b]).lower().split())
            if words in seen or words in own:
                gone |= set(range(a, b))
            own.add(words)
        seen |= own
        out[i] = "".join(p for k, p in enumerate(parts) if k not in gone)
    return out


def test_short_sentences_against_plain_strings(spark):
    rnd = random.Random(6)
    pool = [words(rnd, rnd.randrange(1, 12)).capitalize() + rnd.choice([".", "!", "?!", '."']) for _ in range(25)]
    rows = []
    for i in range(150):
        at = rnd.randrange(20)
        new = [words(rnd, rnd.randrange(1, 12)) + "." for _ in range(6)]
        rows.append((i, rnd.choice([" ", "  ", " "]).join([*new[:3], *pool[at:at + rnd.randrange(8)], *new[3:], *rnd.choices(pool, k=rnd.randrange(5))])))
    rows += [(1000, rows[3][1] + " " + rows[3][1]), (1001, rows[5][1].upper())]
    got = {r.doc_id: r.text for r in S.dedup(documents(spark, [(i, t, "en", "a") for i, t in rows])).collect()}
    want = plain_dedup(rows)
    assert got == want and sum(want[i] != t for i, t in rows) > 30


def test_rows_with_null_keys_are_told_apart(spark):
    text = prose(random.Random(7), 12)
    rows = [(None, text, "en", "a")] * 3 + [(5, "Other words.", "en", "a")]
    assert sorted(r.text for r in S.dedup(documents(spark, rows)).collect()) == sorted(["", "", text, "Other words."])
    got = S.dedup(documents(spark, [*rows, (7, text, "en", "a")])).collect()
    assert [r.doc_id for r in got if r.text == text] == [7]


def test_capitals_spaces_and_scripts_of_one_text():
    rnd = random.Random(8)
    one = prose(rnd, 8)
    other = re.sub(" ", "\u00a0 ", one).upper()
    assert [h for h, *_ in S.spans(one)] == [h for h, *_ in S.spans(other)]
    assert "".join(t for t in [other[i:j] for i, j in S.sentences(other)]) == other
    for t in ["İstanbul " * 40, "𝒳 " * 60, "a" * 41 + "。" + "b " * 30, "\u0e01" * 100 + " x. " * 30]:
        parts = S.sentences(t)
        assert "".join(t[i:j] for i, j in parts) == t and all(i < j for i, j in parts) and list(S.spans(t))
