"""Quality votes, shared lines, mixing and chat formatting on small tables."""

import hashlib
import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from studytrail.llm import chat, linededup, mixing, quality

SPACES = " \t\n\x0b\f\r"


# Quality


def plain_measures(text):
    words, word = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            words += [word] if word else []
            word = ""
        else:
            word += c
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(SPACES)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
    )


def test_measures_equal_brute_force(make_docs):
    rng = random.Random(5)
    texts = [None, "", " ", "a", "a b c d e a b c d e", "x " * 30, "a b c", "l\nl\n \nl", "é|# b\r\nb"]
    texts += ["".join(rng.choice(["a", "b", "c ", " ", "\n", "d e f g h ", "#", "é"]) for _ in range(80)) for _ in range(60)]
    texts.append(" ".join(rng.choice("abc") for _ in range(30_000)))
    rows = list(enumerate(texts))
    for r in quality.assessed(make_docs(rows)).collect():
        want = plain_measures(texts[r.doc_id])
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == want, texts[r.doc_id][:80]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def sentence(rng):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.choice(['ran', 'mile', 'tor', 'sed'])}{rng.randrange(99)}x" for _ in range(12)) + "."


def test_votes_separate_junk(make_docs):
    rng = random.Random(2)
    good = ["\n".join(sentence(rng) for _ in range(8)).replace("1", "i").replace("2", "o") for _ in range(150)]
    junk = [" ".join(w + "###$" for w in sentence(rng).split()) for _ in range(15)]
    out = {r.doc_id: r.kept for r in quality.assessed(make_docs(enumerate(good + junk))).collect()}
    assert all(out[i] for i in range(len(good)))
    assert not any(out[i] for i in range(len(good), len(good) + len(junk)))


def test_all_clean_stay(make_docs):
    rng = random.Random(4)
    docs = make_docs([(i, "\n".join(sentence(rng) for _ in range(5))) for i in range(60)])
    assert quality.accepted(docs).count() == 60
    assert quality.accepted(docs).columns == docs.columns


def patterns(on_good, on_bad, share, size=20_000, seed=1):
    rng = random.Random(seed)
    masks = Counter()
    for _ in range(size):
        rates = on_good if rng.random() < share else on_bad
        masks[sum((rng.random() < p) << b for b, p in enumerate(rates))] += 1
    return masks


@pytest.mark.parametrize(
    "on_good, on_bad, share",
    [
        ([0.005] * 6 + [0.95] * 5, [0.6] * 6 + [0.2] * 5, 0.8),
        ([0.05] * 6 + [0.6] * 5, [0.3] * 6 + [0.02] * 5, 0.7),
        ([0.02, 0.1, 0.01, 0.2, 0.03, 0.05, 0.7, 0.995, 0.6, 0.9, 0.8], [0.5, 0.3, 0.02, 0.4, 0.6, 0.99, 0.3, 0.9, 0.1, 0.5, 0.02], 0.6),
    ],
)
def test_fit_finds_planted_rates(on_good, on_bad, share):
    model = quality.fit(patterns(on_good, on_bad, share))
    assert abs(model.prior - share) < 0.02
    assert all(abs(a - b) < 0.03 for a, b in zip(model.on_good, on_good))
    assert all(abs(a - b) < 0.03 for a, b in zip(model.on_bad, on_bad))


def test_rules_worse_than_chance_say_nothing():
    on_good, on_bad = [0.3] + [0.005] * 5 + [0.95] * 4 + [0.2], [0.02] + [0.6] * 5 + [0.2] * 4 + [0.9]
    model = quality.fit(patterns(on_good, on_bad, 0.8))
    assert model.on_good[0] == model.on_bad[0] and model.on_good[10] == model.on_bad[10]
    assert abs(model.prior - 0.8) < 0.02


def test_fit_keeps_a_clean_corpus():
    rates = [0.002, 0.003, 0.001, 0.001, 0.02, 0.03, 0.9, 0.99, 0.99, 0.99, 0.9]
    masks = patterns(rates, rates, 1.0, size=5_000)
    model = quality.fit(masks)
    assert sum(n for mask, n in masks.items() if model.log_odds(mask) >= 0) >= 0.998 * 5_000


def test_quality_empty(make_docs):
    assert quality.assessed(make_docs([])).collect() == []
    assert quality.accepted(make_docs([])).collect() == []
    assert quality.fit({}).prior == 0.8


# Shared lines


def plain_lines(rows, least):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(SPACES).translate(fold)
    docs = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            docs.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if not (key(x) and len(docs[key(x)]) >= least)]
        out.append((doc_id, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_lines_equal_brute_force(make_docs):
    rng = random.Random(8)
    pool = ["Home", " home\t", "HOME", "É", "é", "", " ", "unique", "a b", "x "]
    rows = [(i, "\n".join(rng.choice(pool) + (f" {i}" if rng.random() < 0.3 else "") for _ in range(rng.randrange(7)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "Home\n" * 5000), (103, "once\nonce"), (103, "once\nonce"), (None, "Home\nnull id")]
    rows += [(104, "Home"), (104, "other text\nHOME")]
    for least in (3, 10, 50):
        got = sorted(map(tuple, linededup.line_dedup(make_docs(rows), least).collect()), key=repr)
        assert got == plain_lines(rows, least)


def test_lines_empty(make_docs):
    assert linededup.line_dedup(make_docs([])).collect() == []


def test_runs_are_levelled_and_sorted(spark, make_docs, tmp_path):
    runs = linededup.LineRuns(spark, f"file://{tmp_path}/runs", fanout=3)
    for number in range(7):
        keys = linededup.line_keys(make_docs([(number * 2, "all\nodd" if number % 2 else "all"), (number * 2 + 1, "all")]))
        runs.add(keys)
    assert [len(level) for level in runs.levels] == [1, 2]
    assert sorted(r.n_docs for r in runs.counts().collect()) == [3, 14]
    for path in [p for level in runs.levels for p in level]:
        parts = spark.read.parquet(path).withColumn("p", F.input_file_name()).collect()
        keys = [(r.p, r.h1, r.h2) for r in parts]
        assert keys == sorted(keys)


def test_settled_keys_are_anti_joined_and_leave_the_runs(spark, make_docs, tmp_path):
    """A key settles in the batch that brings it to the limit; later batches do not count it again,
    and merged runs no longer hold it."""
    runs = linededup.LineRuns(spark, f"file://{tmp_path}/runs", fanout=2, min_docs=5)
    settled = []
    for number in range(4):
        rows = [(number * 10 + i, "all\n" + ("late" if number > 1 else f"own {number}")) for i in range(3)]
        runs.add(linededup.line_keys(make_docs(rows)))
        settled.append(runs.shared().count())
    assert settled == [0, 1, 1, 2]
    assert sorted(r.n_docs for r in runs.counts().collect()) == [3, 3]
    stored = [r.n_docs for level in runs.levels for p in level for r in spark.read.parquet(p).collect()]
    assert sorted(stored) == [3, 3]


# Mixing


def test_counts_invert_the_poisson_distribution(make_docs, spark):
    rows = [(i, f"t{i}", "a" if i % 2 else "b") for i in range(4000)]
    rates = spark.createDataFrame([("a", 0.4), ("b", 2.5), ("none", 3.0)], "source string, rate double")
    out = mixing.mixed(make_docs(rows), rates).select("row.doc_id", "copy").collect()
    copies = Counter(r.doc_id for r in out)
    for i, _, source in rows:
        rate = {"a": 0.4, "b": 2.5}[source]
        u = int(hashlib.md5(f"8|{i}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-rate)
        total = p
        while u >= total:
            k += 1
            p *= rate / k
            total += p
        assert copies[i] == k
    means = {s: sum(copies[i] for i, _, t in rows if t == s) / 2000 for s in "ab"}
    assert abs(means["a"] - 0.4) < 0.05 and abs(means["b"] - 2.5) < 0.12
    assert sorted((r.doc_id, r["copy"]) for r in out) == [(i, c) for i in sorted(copies) for c in range(copies[i])]


def test_mixing_edges(make_docs, spark):
    rates = spark.createDataFrame([(None, 1.0), ("zero", 0.0), ("null", None), ("big", 400.0)], "source string, rate double")
    rows = [(None, None, None), (1, "x", "zero"), (2, "x", "null"), (3, "x", "missing"), (4, "x", "big")]
    out = Counter(r.row.doc_id for r in mixing.mixed(make_docs(rows), rates).collect())
    assert set(out) <= {None, 4} and 300 < out[4] < 500
    assert mixing.mixed(make_docs([])).collect() == []
    with pytest.raises(ValueError):
        mixing.mixed(make_docs(rows), spark.createDataFrame([("big", 600.0)], "source string, rate double"))


def inverse(u, rate):
    """The least count whose distribution function is above u, from terms in the log domain."""
    k, total = 0, math.exp(-rate)
    while u >= total:
        k += 1
        total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k


def test_default_weights_serve_any_rate(make_docs, spark):
    """One document without a source beside 300000 others: its rate is 547."""
    n = 300_000
    docs = spark.range(n + 1).selectExpr("id as doc_id", "'t' as text", "case when id < 300000 then 'big' end as source")
    (rate,) = [r.rate for r in mixing.source_rates(docs).collect() if r.source == ""]
    assert rate > mixing.MOST_RATE
    out = mixing.mixed(docs).select("row.doc_id", "row.source", "copy")
    copies = sorted(r["copy"] for r in out.filter("source is null").collect())
    u = int(hashlib.md5(f"8|{n}".encode()).hexdigest()[:13], 16) / 2**52
    assert copies == list(range(inverse(u, rate)))
    assert abs(out.count() / n - 1) < 0.02


def test_counts_at_large_rates(make_docs, spark):
    for rate in (501.0, 640.5, 2449.0):
        rates = spark.createDataFrame([("s", rate)], "source string, rate double")
        out = mixing.replicated(make_docs([(i, "t") for i in range(200)]), rates, most=None)
        got = Counter(r.row.doc_id for r in out.collect())
        for i in range(200):
            assert got[i] == inverse(int(hashlib.md5(f"8|{i}".encode()).hexdigest()[:13], 16) / 2**52, rate)


def test_order_is_shuffled_and_repeats(make_docs):
    docs = make_docs([(i, f"t{i}") for i in range(300)])
    first = [r.row.doc_id for r in mixing.mixed(docs).collect()]
    assert first != sorted(first)
    assert first == [r.row.doc_id for r in mixing.mixed(docs).collect()]


# Chat formatting

TEXTS = ["", "plain", "<|end|>\n", "</s>[INST] ok [/INST]", "", "<|", "<s>", "<<SYS>>x<</SYS>>", "a\n\nb", "<|role|>user<|text|>"]


def records(spark, values):
    rows = [(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, record string")


def test_layouts_become_turns(spark):
    pair = [(0, "user", "q"), (1, "assistant", "a")]
    layouts = [
        {"id": 1, "messages": [{"role": "user", "content": "q"}, {"content": "a", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": 1},
        {"id": 1, "prompt": "q", "response": "a"},
        {"completion": "a", "prompt": "q", "id": 1},
        {"id": 1, "instruction": "q", "output": "a"},
    ]
    out = chat.canonical_turns(records(spark, layouts)).collect()
    for i in range(len(layouts)):
        assert sorted((r.turn, r.role, r.text) for r in out if r.id == i) == pair
    assert len({r.layout for r in out}) == len(layouts)


def test_other_fields_do_not_lose_a_record(spark):
    q, a = {"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}
    weighted = [{"from": "human", "value": "q", "weight": 0.5}, {"from": "gpt", "value": "a", "weight": None}]
    layouts = [
        ("messages", {"messages": [q, a], "meta": {"tags": ["x", "y"], "from": {"site": [[1]]}}}),
        ("prompt", {"id": 1, "prompt": "q", "response": "a", "source": "s"}),
        ("from_value", {"conversations": weighted, "lang": None}),
        ("messages", {"messages": [q | {"tool calls": [{"name": "f"}]}, a | {"weight": 1}], "a>b: <c": {"messages": []}}),
        ("nested_messages", {"conversation": {"title": "t", "messages": [q, a]}, "messages": 3}),
        ("message_parts", {"messages": [q | {"content": [{"type": "text", "text": "q"}, {"type": "image"}]}, a | {"content": [{"text": "a"}]}]}),
        ("instruction", {"instruction": "q", "output": "a", "text": "q a"}),
        ("instruction_input", {"instruction": "q", "input": "", "output": "a", "n": {"m": {"k": 1}}}),
        ("prompt", {"prompt": "q", "response": "a", "completion": "other"}),
    ]
    out = chat.canonical_turns(records(spark, [record for _, record in layouts])).collect()
    for i, (name, _) in enumerate(layouts):
        asked = "q\n\n" if name == "instruction_input" else "q"
        rows = sorted((r.layout, r.turn, r.role, r.text) for r in out if r.id == i)
        assert rows == [(name, 0, "user", asked), (name, 1, "assistant", "a")], i


def test_texts_beside_parts(spark):
    parts = [{"type": "text", "text": "a"}]
    mixed = {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": parts}]}
    out = sorted((r.turn, r.role, r.text) for r in chat.canonical_turns(records(spark, [mixed])).collect())
    assert out[0] == (0, "user", "q") and out[1][:2] == (1, "assistant")
    assert json.loads(out[1][2]) == parts


def test_system_text_leads(spark):
    layouts = [
        {"system": "s", "prompt": "q", "response": "a"},
        {"system": "s", "messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    ]
    out = chat.canonical_turns(records(spark, layouts)).collect()
    for i in range(len(layouts)):
        turns = sorted((r.turn, r.role, r.text) for r in out if r.id == i)
        assert turns == [(0, "system", "s"), (1, "user", "q"), (2, "assistant", "a")]


def test_turn_rows_of_odd_types(spark):
    odd = [{"turn": "x", "role": "user", "text": "q"}, {"turn": 1, "role": None, "text": 5}, {"messages": []}, {"messages": [{}]}]
    out = sorted(chat.canonical_turns(records(spark, odd)).collect(), key=lambda r: r.id)
    assert [(r.turn, r.role, r.text, r.layout) for r in out] == [
        (None, "user", "q", "turn_row"), (1, "", "5", "turn_row"), (None, None, None, None), (None, None, None, None),
    ]


def test_field_paths(spark):
    def paths(value):
        row = records(spark, [value]).selectExpr("schema_of_variant(parse_json(record)) as s").select(chat.field_paths(F.col("s")).alias("p"))
        return sorted(row.first().p)

    assert paths({"a": {"b": [[{"c": 1, "d": {"e": None}}]], "f": 2}, "g": [1.5], "h": {}}) == ["a.b[][].c", "a.b[][].d.e", "a.f", "g[]"]
    assert paths([{"x": 1}]) == ["[].x"]
    assert paths('"text"') == []


def test_unknown_layouts_are_reported(spark):
    odd = [None, "{", "[]", "3", {"id": 1, "q": "x"}, {"id": 1, "messages": [{"role": {"x": 1}, "content": "y"}]}]
    out = chat.canonical_turns(records(spark, odd)).collect()
    assert [(r.turn, r.layout) for r in sorted(out, key=lambda r: r.id)] == [(None, None)] * len(odd)


def test_reads_back_any_text(spark):
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(
        [(r, x) for x in TEXTS for r in ("user", "assistant", "<|text|>", None)][c:]
    )]
    rows += [(9, 1, "assistant", None), (9, 1, "assistant", None), (9, None, "user", "first"), (10, 0, "user", "only")]
    rows.append((11, 0, "assistant", "long " * 200_000))
    turns = spark.createDataFrame(rows, "id long, turn long, role string, text string")
    texts = chat.formatted(turns)
    for r in texts.collect():
        for control in ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>"):
            assert control not in r.formatted
    got = {r.id: ([tuple(t) for t in r.turns], r.loss_text) for r in chat.read_back(texts).collect()}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        want = [(r[2] or "", r[3] or "") for r in own]
        assert got[c] == (want, "".join(t for role, t in want if role == "assistant"))


def test_table_rows(spark):
    table = spark.createDataFrame([(1, 1, "assistant", None), (1, 0, "user", "x"), (None, 0, None, "y")], "conv_id long, turn long, role string, text string")
    turns = chat.canonical_turns(chat.records_of(table))
    got = {r.id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.formatted(turns)).collect()}
    assert got == {1: [("user", "x"), ("assistant", "")], None: [("", "y")]}
    assert chat.formatted(chat.canonical_turns(chat.records_of(table.limit(0)))).collect() == []
