"""Passages that repeat inside lines lose their sentences, by brute force over runs of units."""

import random
import re

from citeloom.llm import lines

SPACE = r"[\x20\x09-\x0D]+"


def brute(rows, least):
    """rows in order of rank: what is left of each text."""
    seen, out = set(), []
    for text in rows:
        if text is None:
            out.append(None)
            continue
        cuts = [0, *(m.end() for m in re.finditer(rf"(?<=[.!?]){SPACE}|\n", text)), len(text)]
        parts = [text[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        marks = []
        for part in parts:
            key = re.sub(SPACE, " ", part).strip(" ").lower()
            marks.append(None if not key else key in seen)
            seen.add(key)
        gone = set()
        for i in range(len(parts)):
            for j in range(i, len(parts)):
                run = range(i, j + 1)
                if marks[i] and marks[j] and all(marks[x] is not False for x in run) and sum(len(re.findall(r"[^\x20\x09-\x0D]+", parts[x])) for x in run) >= least:
                    gone |= set(run)
        out.append("".join(p for x, p in enumerate(parts) if x not in gone))
    return out


def test_passages_inside_lines(spark):
    passage = "The court finds the motion well taken today. Costs are taxed to the party that lost.\nSo it is ordered here and now."
    texts = {1: f"Own words of the first come before. {passage} Then more of its own words follow.", 2: f"Second text has another lead in. {passage.upper().replace(chr(10), ' ')} And its very own end of it.", 3: "Costs are  taxed to the party that lost.\nlast line"}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(df).collect()}
    assert got[1].text == texts[1] and got[3].text == texts[3]
    assert got[2].text == "Second text has another lead in. And its very own end of it." and got[2].n_removed == 3


def test_against_brute_force(spark):
    r = random.Random(4)
    sentence = lambda: " ".join(r.choice("abcdefgh") * r.randrange(1, 3) for _ in range(r.randrange(1, 14))) + r.choice((".", ".", "!", "", "?!"))
    pool = [sentence() for _ in range(40)]
    rows = [(i, r.choice((None, "")) if i % 37 == 36 else r.choice(("", "\n", " ")) + "".join(x + r.choice((" ", "  ", "\n", "\n\n", "\t\n")) for x in (r.choice(pool) if r.random() < 0.6 else sentence() for _ in range(r.randrange(1, 30))))) for i in range(150)]
    rows += [(1000, "word " * 60_000 + "end. " + " ".join(rows[5][1].split(" ")))]  # a very long text
    df = spark.createDataFrame([(*x, 7, "c") for x in rows + rows[:20]], "doc_id long, text string, gone int, version string").repartition(7)
    for least in (1, 12, 20):
        want = dict(zip((i for i, _ in rows), brute([t for _, t in rows], least), strict=True))
        got = lines.dedup_lines(df, min_words=least).collect()
        assert len(got) == len(rows) + 20
        for x in got:
            text = dict(rows)[x.doc_id]
            assert x.text == want[x.doc_id]
            at, kept = 0, []
            for a, b in x.removed or []:
                kept.append(text[at:a])
                at = b
            assert text is None or "".join([*kept, text[at:]]) == x.text


def test_texts_of_one_id(spark):
    """Different texts of one id are documents of their own; equal ones are one."""
    passage = " ".join(f"w{i}" for i in range(30)) + "."
    df = spark.createDataFrame([(1, f"one {passage}\n{passage}"), (1, f"two\n{passage}"), (1, f"two\n{passage}"), (2, passage)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in lines.dedup_lines(df).collect())
    assert got[-1] == (2, 1) and sum(n for d, n in got if d == 1) in (1, 2) and len(got) == 4
