import random

from filmgraph.llm import line_rules as L

GOOD = "This is a plain sentence with quite a few words in it. " * 2


def varied(n):
    return " ".join(f"w{i}" for i in range(n)) + "."


def brute_repeated(words):
    n = len(words)
    wins = [tuple(words[i:i + 3]) for i in range(n - 2)]
    hit = set()
    for i, w in enumerate(wins):
        if wins.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    return len(hit)


def test_repeated_words_match_brute_force():
    rng = random.Random(5)
    for _ in range(300):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        assert L.repeated_words(words) == brute_repeated(words)


def test_line_verdicts():
    rules = L.LineRules()
    assert L.line_verdict("Home | About | Contact | Help", 7, rules) == "nav"
    assert L.line_verdict("the*** of### a&&& is%%%", 4, rules) == "noise"
    assert L.line_verdict("BUY!! NOW!! CHEAP!!", 3, rules) == "noise"
    assert L.line_verdict("Read our Privacy Policy before you go.", 7, rules) == "boilerplate"
    assert L.line_verdict("Next page", 2, rules) == "fragment"
    assert L.line_verdict('He said "yes."', 3, rules) is None
    assert L.line_verdict(varied(20), 20, rules) is None


def test_text_is_rejected_when_too_much_is_lost():
    menu = "\n".join("a | b | c | d | e" for _ in range(40))
    kept = L.judge_text(varied(60) + "\n" + "x | y | z", L.LineRules())
    assert kept[6] and kept[-1] == varied(60)
    lost = L.judge_text(varied(60) + "\n" + menu * 3, L.LineRules())
    assert not lost[6]


def test_nulls_empty_long_repeated_and_clashing(llm):
    rows = [(1, None, 5), (2, "", 6), (None, varied(80), 7), (2, "", 6), (3, "x" * 300_000, 8),
            (4, "\n".join([varied(60)] * 2), 9)]
    df = llm.createDataFrame(rows, "doc_id long, text string, kept long")
    out = L.judge(df, "q").select("doc_id", "kept", "q.*")
    got = [tuple(r) for r in out.select("doc_id", "n_words", "word_chars", "n_symbols",
                                        "n_dup_lines", "n_repeat_words", "base_failed").collect()]
    assert got[0] == (1, 0, 0, 0, 0, 0, True) and got[1] == (2, 0, 0, 0, 0, 0, True)
    assert got[3] == got[1]
    assert got[2][:2] == (None, 80) and not got[2][-1]
    assert got[4] == (3, 1, 300_000, 0, 0, 0, True)
    assert got[5][4] == 1 and got[5][5] == 120 and got[5][-1]
    assert [r[0] for r in L.judge(df, "q").select("kept").collect()] == [5, 6, 7, 6, 8, 9]


def test_empty_table(llm):
    df = llm.createDataFrame([], "doc_id long, text string")
    assert L.judge(df, "q", with_cleaned=True).count() == 0
