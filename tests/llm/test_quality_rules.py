import random
import re
from collections import Counter

from llm_texts import prose

from asterlap.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen = Counter(runs)
    covered = {i + j for i, r in enumerate(runs) if seen[r] > 1 for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^ \t-\r]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(documents):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a b c d e f g h i ", "x\n", "# $ é \n"]) * rng.randint(0, 6) + " ".join(rng.choices("pq", k=rng.randint(0, 40)))) for i in range(80)]
    got = {r.doc_id: r for r in Q.judge(documents(rows)).collect()}
    for i, text in rows:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), text
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)


def test_lines_of_many_documents_go_but_copies_are_no_evidence(documents):
    common = "All rights  reserved by all of us here"
    rows = [(i, common.upper() + "\n" + prose(i, 40)) for i in range(30)]
    rows += [(100 + i, common + "\n" + prose(i + 500, 5) + " " + " ".join("w" * (k + 1) for k in range(15)), "t") for i in range(10)]
    rows += [(200 + i, prose(900, 50)) for i in range(60)]
    rows += [(400 + i, "\n".join([common, "Again: " + common, prose(i, 4)]) + f" {i} b c d") for i in range(30)]
    got = {r.doc_id: r for r in Q.judge(documents(rows)).collect()}
    assert all(got[i].kept and got[i].n_line_words == 8 for i in range(30))
    assert all(got[100 + i].n_line_words == 0 for i in range(10)), "another host, below the limit"
    assert all(got[i].kept and not got[i].n_line_words for i in range(200, 260))
    texts = {r.doc_id: r.text for r in Q.clean(documents(rows)).collect()}
    assert texts[3] == prose(3, 40) and texts[203] == rows[43][1]


def test_depleted_documents_are_rejected(documents):
    lines = [f"{prose(k, 12)}" for k in range(3)]
    rows = [(i, "\n".join([*lines, prose(1000 + i, 6)])) for i in range(40)]
    rows += [(100 + i, f"{lines[i % 3]}\n{prose(2000 + i, 60)}") for i in range(90)]
    got = {r.doc_id: r for r in Q.judge(documents(rows)).collect()}
    assert not any(got[i].kept or got[i].base_failed for i in range(40))
    assert all(got[i].kept for i in range(100, 190))
    assert Q.clean(documents(rows)).count() == 90


def test_odd_rows(odd, documents):
    df, rows = odd
    got = Q.judge(df).collect()
    measured = sorted(str((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)
    assert measured == sorted(str((r[0], *brute(r[1]))) for r in rows)
    assert len(got) == len(rows)
    assert Q.clean(df).columns == df.columns
    assert Q.judge(documents([])).count() == 0 and Q.clean(documents([])).count() == 0


def test_documents_that_share_several_lines_are_distinct(documents):
    shared = [f"{prose(k, 8)}" for k in range(3)]
    rows = [(i, "\n".join([*shared[: 1 + i % 3], prose(100 + i, 5), prose(600 + i, 60)])) for i in range(23)]
    depleted = [(100 + i, "\n".join([prose(3, 40), prose(4, 40), prose(700 + i, 25)]), "t") for i in range(25)]
    again = [(i + 1000, text.upper().replace("\n", " \n\n"), *host) for i, text, *host in rows + depleted]
    got = {r.doc_id: r for r in Q.judge(documents(rows + depleted + again)).collect()}
    assert all(got[i].n_line_words == got[i + 1000].n_line_words == 8 for i in range(23) if i % 3 == 0), "in 23 documents"
    assert all(got[i].n_line_words == 8 for i in range(23)), "the other lines are in fewer"
    assert all(got[100 + i].n_line_words == 80 and not got[100 + i].kept and not got[1100 + i].kept for i in range(25))


def brute_verdicts(rows, limit):
    """n_line_words and kept of rows (doc_id, text, host), all pairs of lines and documents counted in sets."""
    normal = lambda line: re.sub(r"[ \t-\r]+", " ", line.lower()).strip(" ")
    lines = {i: [normal(x) for x in (text or "").split("\n") if re.search(r"[^ \t-\r]", x)] for i, text, _ in rows}
    holders = {}
    for i, _, host in rows:
        for line in lines[i]:
            holders.setdefault((host or "", line), set()).add(tuple(lines[i]))
    out = {}
    for i, text, host in rows:
        taken = sum(len(x.split(" ")) for x in lines[i] if len(holders[host or "", x]) > limit)
        n, _, _, _, repeated = brute(text)
        out[i] = taken, n >= 20 and 100 * repeated <= 30 * n and 100 * (n - taken) >= 30 * n
    return out


def test_verdicts_against_brute_force(documents, monkeypatch):
    monkeypatch.setattr("asterlap.llm.common.FEW_ROWS", 0)
    rng = random.Random(11)
    common = [prose(k, rng.randint(3, 25)) for k in range(12)]
    rows = []
    for i in range(500):
        own = [prose(5000 + rng.randint(0, 120), rng.randint(4, 50)) for _ in range(rng.randint(0, 2))]
        lines = rng.sample(common, k=min(12, int(rng.expovariate(0.5)))) + own
        rng.shuffle(lines)
        if i % 7 == 0:
            lines = [f"  {x.upper()}\t" for x in lines]
        rows.append((i, rng.choice(["\n", "\n \n"]).join(lines) if i % 50 else None, rng.choice(["s", "s", "t", None])))
    for limit in (5, 20):
        got = {r.doc_id: (r.n_line_words, r.kept) for r in Q.judge(documents(rows), limit).collect()}
        want = brute_verdicts(rows, limit)
        assert got == want
        assert {r.doc_id for r in Q.clean(documents(rows), limit).collect()} == {i for i, (_, kept) in want.items() if kept}
        assert any(taken for taken, _ in want.values()) and len({kept for _, kept in want.values()}) == 2
