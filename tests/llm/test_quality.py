import re
from collections import Counter

from eventlens.llm import quality
from tests.llm.conftest import frame, hard_rows, prose, same_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measure(text):
    t = text or ""
    w = WORD.findall(t)
    grams = list(zip(w, w[1:], w[2:]))
    count = Counter(grams)
    covered = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(covered)


def bits(n, chars, symbols, lines, dup, rep):
    tests = (n < 50, 100 * rep > 50 * n, 10 * symbols > n, chars < 2 * n or chars > 20 * n, 2 * dup > lines, n > 100_000)
    return sum(1 << i for i, x in enumerate(tests) if x)


def rows_():
    rows = hard_rows()
    rows += [(300, "a b c a b c d a b", "en", "s", 0), (301, "a a a a", "en", "s", 0), (302, "a b", "en", "s", 0), (303, "w " * 120_000, "en", "s", 0)]
    rows += [(304, "w#rd $$$ <b> " * 40, "en", "s", 0), (305, "x y   z\x0b\x1c q", "en", "s", 0), (306, "same line here\n" * 60, "en", "s", 0)]
    return rows


def test_ledger_against_brute_force(llm):
    rows = rows_()
    got = quality.ledger(frame(llm, rows, extra=True)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "failed").collect()
    same_rows(got, [(r[0], *(m := measure(r[1])), bits(*m)) for r in rows])


def test_repeated_windows(llm):
    rows = rows_()[:-4]
    got = quality.ledger(frame(llm, rows)).select("doc_id", "n_repeat_words").collect()
    same_rows(got, [(r[0], measure(r[1])[-1]) for r in rows])


def test_policies_and_ablations(llm):
    rows = rows_()
    ledger = quality.ledger(frame(llm, rows)).persist()
    failed = [bits(*measure(r[1])) for r in rows]
    for policy, mask in quality.POLICIES.items():
        same_rows(quality.verdicts(ledger, policy).select("doc_id", "kept").collect(), [(r[0], f & mask == 0) for r, f in zip(rows, failed)])
        got = {r.rule: (r.n_failed, r.n_only, r.n_kept_without) for r in quality.ablations(ledger, policy).collect()}
        assert got == {
            rule.name: (sum(bool(f & mask & 1 << rule.bit) for f in failed), sum(f & mask == 1 << rule.bit for f in failed), sum(f & mask & ~(1 << rule.bit) == 0 for f in failed))
            for rule in quality.RULES
            if mask >> rule.bit & 1
        }


def test_main_path_is_native(llm):
    plan = quality.ledger(frame(llm, rows_()))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "Exchange" not in plan.replace("Exchange RoundRobin", "")


def test_nothing(nothing):
    assert quality.ledger(nothing).collect() == []
