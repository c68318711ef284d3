import re
from collections import Counter

from kerbside.llm import quality
from tests.llm.edge import edge_docs, edge_rows, given, no_docs

SPACE = r"[^\x20\x09-\x0D]+"


def brute_metrics(text):
    text = text or ""
    words = re.findall(SPACE, text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(SPACE, line)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), len(lines)


def brute_rejected(text):
    n, chars, symbols, dup, repeats, lines = brute_metrics(text)
    upper = sum(c.isupper() for c in text or "")
    return (
        n < 20 or 10 * symbols > n or 2 * (text or "").count("!") > n or 2 * upper > chars
        or chars > 15 * n or chars < 2 * n or 2 * dup > lines or 100 * repeats > 30 * n
    )


def measured(docs):
    cut, parts, _ = quality.with_parts(docs)
    metrics = [m.alias(f"m_{name}") for name, m in quality.base_metrics(parts).items()]
    rule = quality.first_rejection(parts, quality.RULES).alias("by")
    return cut.select("text", *metrics, rule).collect()


def test_metrics_and_verdict_by_brute_force(spark):
    for docs in (edge_docs(spark), given(spark)):
        for row in measured(docs):
            assert tuple(row[1:6]) == brute_metrics(row.text)[:5]
            assert (row.by is not None) == brute_rejected(row.text), row


def test_any_order_keeps_the_same(spark):
    docs = edge_docs(spark)
    kept = [sorted(quality.keep_good(docs, rules).collect(), key=repr) for rules in (quality.RULES, quality.RULES[::-1])]
    assert kept[0] == kept[1] and len(kept[0]) == sum(not brute_rejected(t) for _, t, *_ in edge_rows())
    assert quality.keep_good(docs).columns == docs.columns


def test_rules_are_ordered_by_rejection_per_cost():
    rule = quality.RULES[0]
    cheap, costly = quality.Measured(rule, 0.1, 0.2), quality.Measured(rule, 1.0, 0.5)
    assert cheap.rejection_per_cost > costly.rejection_per_cost


def test_ordering_covers_every_rule_and_empty_tables(spark):
    assert set(quality.ordered_rules(given(spark))) == set(quality.RULES)
    assert quality.keep_good(no_docs(spark)).count() == 0


def test_plan_has_no_python_and_no_shuffle(spark):
    text = quality.keep_good(given(spark), quality.RULES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
