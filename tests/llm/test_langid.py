import zlib
from collections import Counter

from seqloom.llm import langid


def plain_grams(text):
    marks = []
    for c in text.lower():
        c = c if c.isalpha() else " "
        if c != " " or not marks or marks[-1] != " ":
            marks.append(c)
    marks = "".join(marks)
    if not marks.strip():
        return Counter()
    marks = " " + marks.strip() + " "
    return Counter(g for n in (1, 2, 3) for i in range(len(marks) - n + 1) if (g := marks[i : i + n]) != " ")


def plain_top(counts, top):
    order = lambda g: [1 if c == " " else ord(c) for c in g]
    return sorted(counts, key=lambda g: (-counts[g], len(g), order(g)))[:top]


def test_against_brute_force(both):
    rows = both.collect()
    rest = [r for r in rows if zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 4 != 2 and r.lang and r.text is not None]
    profiles = {lang: plain_top(sum((plain_grams(r.text) for r in rest if r.lang == lang), Counter()), langid.TOP) for lang in {r.lang for r in rest}}

    def guess(text):
        own = plain_top(plain_grams(text or ""), langid.TOP)
        if not own:
            return "und", 0.0
        apart = sorted((sum(abs(i - p.index(g)) if g in p else langid.TOP for i, g in enumerate(own)), lang) for lang, p in profiles.items())
        return apart[0][1], 1 - apart[0][0] / apart[1][0]

    got = Counter((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in langid.query(both).collect())
    held = lambda r: zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 4 == 2
    assert got == Counter((r.doc_id, held(r), guess(r.text)[0], round(guess(r.text)[1], 9)) for r in rows)


def test_held_out_accuracy(small):
    lang = {r.doc_id: r.lang for r in small.collect()}
    held = [r for r in langid.query(small).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_accepted_keeps_rows(both):
    kept = langid.accepted(both, langid.learn(both))
    assert kept.columns == both.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in both.collect() if any(c.isalpha() for c in r.text or ""))


def test_empty_and_unlearned(empty, odd):
    assert langid.query(empty).collect() == []
    nothing = langid.learn(empty)
    assert {r.lang_pred for r in langid.identify(odd, nothing).collect()} == {"und"}


def test_all_texts_are_learned_from(spark):
    """No text is drawn: of 3000 texts with a letter of their own the profile has the first letters of all that may be learned from."""
    rows = [(i, chr(0x4E00 + i), "zh") for i in range(3000)]
    learned = [c for i, c, _ in rows if zlib.crc32(str(i).encode()) % 4 != 2]
    profiles = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(chr(c) for c in profiles.codes.tolist()) == learned[: langid.TOP]
