"""Toxicity, quality rules, decontamination, pseudonyms."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adlake.llm import contamination, pseudonyms, rules, toxicity

BAD = ["grolm", "skab", "vexxo"]


def marked(prose, rng, n=600):
    rows = []
    for i in range(n):
        words = prose(rng.randint(30, 80)).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_classifier_on_held_out_rows(spark, prose, rng):
    rows = spark.createDataFrame(marked(prose, rng), "doc_id bigint, text string, toxic int")
    model = toxicity.fit(rows.where("doc_id % 3 != 1"), rows.select("doc_id", "toxic").where("doc_id % 3 != 1"))
    assert 0 < len(model[0]) < 500
    held = rows.where("doc_id % 3 = 1").withColumn("p", toxicity.scorer(spark, model)).collect()
    assert all((r.p >= 0.7) == bool(r.toxic) for r in held)


def test_a_sample_bounds_what_is_learned_from(spark, prose, rng):
    rows = spark.createDataFrame(marked(prose, rng), "doc_id bigint, text string, toxic int")
    assert len(toxicity.fit(rows, rows.select("doc_id", "toxic"), max_rows=100)[0]) > 0


def test_scores_without_labels_and_of_messy_rows(spark, messy, nothing):
    none = spark.createDataFrame([(None, 1), (1, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(messy, none)
    assert {r.p for r in messy.withColumn("p", toxicity.scorer(spark, model)).collect()} == {0.5}
    assert nothing.withColumn("p", toxicity.scorer(spark, toxicity.fit(nothing, none))).count() == 0
    twice = spark.createDataFrame([(1, 0), (1, 1), (5, 0)], "doc_id bigint, toxic int")
    assert messy.withColumn("p", toxicity.scorer(spark, toxicity.fit(messy, twice))).count() == messy.count()


def base(text):
    found = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = list(zip(found, found[1:], found[2:], strict=False))
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(found), sum(map(len, found)), symbols, len(lines) - len(set(lines)), len(covered)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_base_counts(spark, messy, nothing, rng):
    signs = ["a", "b", "É", " ", " ", "\n", "\t", "#", "<>", "\x0b", "日 ", "\x85", "a b c "]
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in rules.statistics(docs).collect()}
    assert got == {i: base(t) for i, t in rows}
    assert sorted(tuple(r[c] for c in COUNTS) for r in rules.statistics(messy).collect()) == sorted(base(r.text or "") for r in messy.collect())
    assert rules.statistics(nothing).count() == 0


def test_learned_list_on_held_out_rows(spark, rng, prose):
    rows = []
    for i in range(500):
        text = " ".join(f"{w}{rng.randrange(10**6)}" for w in prose(80).split())
        poor = i % 4 == 0
        rows.append((i, text.replace(" ", " ## ", 30) if poor and i % 8 else text.upper() if poor else text, int(not poor)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int")
    out = rules.judge(docs, docs.where("doc_id % 3 != 1").select("doc_id", "quality")).join(docs.select("doc_id", "quality"), "doc_id")
    held = out.where("doc_id % 3 = 1").collect()
    assert not any(r.base_failed for r in held)
    assert sum(r.kept != bool(r.quality) for r in held) <= 0.03 * len(held)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CASE WHEN" in plan


def test_rules_without_labels(spark, messy, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id bigint, quality int")
    for labels in (none, one):
        out = rules.judge(messy, labels).collect()
        assert len(out) == messy.count() and all(r.kept != r.base_failed for r in out)
        assert rules.judge(nothing, labels).count() == 0


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def hits_of(text, items, window=10):
    found = WORD.findall((text or "").translate(FOLD))
    covered, which = set(), set()
    for item, body in items:
        own = WORD.findall((body or "").translate(FOLD))
        n = min(window, len(own))
        if not n or item is None:
            continue
        grams = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(found) - n + 1):
            if tuple(found[i : i + n]) in grams:
                covered.update(range(i, i + n))
                which.add(item)
    return len(found), covered, which


@pytest.mark.parametrize("block_bytes", [contamination.BLOCK_BYTES, 400])
def test_hits_are_all_windows(spark, rng, prose, block_bytes):
    few = ["a", "b", "c"]
    items = [(i, prose(rng.choice([3, 9, 10, 25, 40]))) for i in range(20)] + [(30, " ".join(rng.choice(few) for _ in range(30))), (31, "b"), (32, ""), (33, None), (None, "x y")]
    items += [(40, items[0][1]), (41, items[3][1])]
    docs = []
    for i in range(150):
        words = prose(rng.randint(0, 60)).split()
        if i % 3 == 0:
            own = rng.choice(items)[1] or ""
            own = own.split()
            a = rng.randrange(len(own) + 1)
            words[rng.randrange(len(words) + 1) : 0] = own[a : a + rng.randint(5, 40)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words).upper() if i % 7 else " ".join(rng.choice(few) for _ in range(50))))
    rows = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for r in contamination.decontaminate(rows, bench, block_bytes=block_bytes).withColumn("n_hit", contamination.words_hit(F.col("hits"))).collect():
        n, covered, which = hits_of(r.text, items)
        assert r.hits.n_words == n and set(r.hits["items"]) == which and r.n_hit == len(covered)
        assert {i for a, b in zip(r.hits.start, r.hits.end, strict=True) for i in range(a, b)} == covered


def test_decontamination_of_messy_tables(spark, messy, nothing):
    bench = spark.createDataFrame([(1, "plain words"), (2, "tail " * 50), (2, None)], "item_id bigint, text string")
    out = contamination.decontaminate(messy, bench, into="found").collect()
    assert all(r.hits == "a" for r in out) and len(out) == messy.count()
    for r in out:
        n, covered, which = hits_of(r.text, [(1, "plain words"), (2, "tail " * 50)])
        assert r.found.n_words == n and set(r.found["items"]) == which
    assert contamination.decontaminate(nothing, bench).count() == 0
    assert all(not r.found["items"] for r in contamination.decontaminate(messy, bench.limit(0), into="found").collect())


@pytest.mark.parametrize("block_bytes", [contamination.BLOCK_BYTES, 200])
def test_hits_of_texts_that_repeat_themselves(spark, rng, block_bytes):
    items = [("one", "0 " * 40), ("two", "0 1 " * 20), ("three", "a b c " * 9 + "d " * 12), ("short", "1 0 1"), ("same", "0 " * 40), ("dash-id", "0 " * 9 + "1")]
    docs = [(0, "0 " * 300), (1, "0 1 " * 100), (2, "c a b " * 30 + "d " * 30), (3, "0 " * 9 + "x " + "0 " * 10), (4, "1 " + "0 " * 30 + "1 " * 3)]
    docs += [(k, " ".join(rng.choice("01") for _ in range(400))) for k in range(5, 25)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    bench = spark.createDataFrame(items, "item_id string, text string")
    for r in contamination.decontaminate(rows, bench, block_bytes=block_bytes).collect():
        n, covered, which = hits_of(r.text, items)
        assert r.hits.n_words == n and set(r.hits["items"]) == which and len(r.hits["items"]) == len(which)
        assert {i for a, b in zip(r.hits.start, r.hits.end, strict=True) for i in range(a, b)} == covered
        assert all(b < c for b, c in zip(r.hits.end, r.hits.start[1:], strict=False))


def test_long_repetition_on_both_sides_ends(spark):
    import time

    import pyarrow as pa

    items = ["0 " * 5_000, "0 1 " * 2_500, *(f"answer the following question with one of the words below please {k}" for k in range(3_000))]
    began = time.monotonic()
    bench = contamination.index(items)
    column = pa.array(["0 " * 100_000, "0 1 1 " * 30_000, "answer the following question with one of the words below please " * 3_000])
    out = contamination.hits(column, bench, pa.array(range(len(items)))).to_pylist()
    assert time.monotonic() - began < 20
    assert (out[0]["start"], out[0]["end"], out[0]["items"]) == ([0], [100_000], [0]) and out[1]["items"] == []
    assert out[2]["items"] == list(range(2, 3_002)) and out[2]["start"] == [0]
    assert len(bench.members) < 10_000


VALUES = {
    "email": "bob.smith+x@mail7.example.org",
    "iban": "DE89 3704 0044 0532 0130 00",
    "date": "2024-02-29",
    "ip": "10.0.0.254",
    "phone": "+1 (217) 555-7713",
    "ssn": "123-45-6789",
    "card": "4111 1111 1111 1111",
}
KEY = b"another key"


@pytest.mark.parametrize("kind", pseudonyms.KINDS)
def test_pseudonyms_keep_the_format_and_come_back(kind):
    value = VALUES[kind]
    text = f"Before ({value}), after."
    new, counts = pseudonyms.rewrite(text, KEY)
    assert counts[kind] == 1 and sum(counts.values()) == 1 and value not in new
    shape = lambda s: re.sub("[0-9]", "0", re.sub("[a-z]", "a", s))
    if kind != "ip":
        assert shape(new) == shape(text)
    assert pseudonyms.rewrite(new, KEY, True) == (text, counts)
    assert pseudonyms.rewrite(text, KEY)[0] == new != pseudonyms.rewrite(text, b"third")[0]


def test_equal_values_stay_linked_across_forms():
    one = lambda s: re.sub(r"\D", "", pseudonyms.rewrite(s, KEY)[0])
    assert one("4111 1111 1111 1111") == one("4111111111111111") == one("4111-1111-1111-1111")
    assert pseudonyms.rewrite("29.02.2024", KEY)[0].split(".")[::-1] == pseudonyms.rewrite("2024-02-29", KEY)[0].split("-")


@pytest.mark.parametrize("text", ["4111111111111112", "2023-02-30", "1.2.3", "300.1.1.1", "000-12-3456", "DE88370400440532013000", "a@b", "681c09b8e90e7e8c9575180f595f646cf2969054", "1234567"])
def test_what_is_not_valid_stays(text):
    assert pseudonyms.rewrite(f"x {text} y", KEY)[0] == f"x {text} y"


CARD, ACCOUNT = "4111 1111 1111 1111", "AT61 1904 3002 3457 3201"


@pytest.mark.parametrize(
    "text, kinds",
    [
        (f"{CARD} 12/26", {"card": 1}),
        (f"{CARD} 123", {"card": 1}),
        (f"{CARD.replace(' ', '-')}-123", {"card": 1}),
        (f"{CARD} 10.0.0.1", {"card": 1, "ip": 1}),
        (f"123 {CARD}", {"card": 1}),
        (f"123-{CARD.replace(' ', '-')}", {"card": 1}),
        (f"{ACCOUNT} BIC", {"iban": 1}),
        (f"{ACCOUNT.replace(' ', '')} 2024", {"iban": 1}),
        ("BE68 5390 0754 7034 GKCC BEBB", {"iban": 1}),
        ("ES91 2100 0418 4502 0005 1332 2024", {"iban": 1}),
        (f"DE88 {CARD} 12/26", {"card": 1}),
        ("+1 217 555 7713 2024 2025 2026", {"phone": 1}),
    ],
)
def test_values_next_to_digits_and_capitals(text, kinds):
    new, counts = pseudonyms.rewrite(f"x {text} y", KEY)
    assert {k: n for k, n in counts.items() if n} == kinds
    assert CARD not in new and CARD.replace(" ", "-") not in new and ACCOUNT not in new and "BE68 5390" not in new
    assert pseudonyms.rewrite(new, KEY, True) == (f"x {text} y", counts)


def test_cards_before_a_code_come_back():
    for k in range(100, 400):
        text = f"{CARD} {k}"
        new, counts = pseudonyms.rewrite(text, KEY)
        assert counts["card"] == 1 and pseudonyms.rewrite(new, KEY, True)[0] == text


def plain(kind, value, back=False):
    """The permutation by its definition: numbers of the kind in a row, walked through until one is read in the same form."""
    x, size, rest = pseudonyms._OF[kind].number(value)
    for _ in range(10_000):
        x = pseudonyms.feistel(x, size, KEY, kind, back)
        new = pseudonyms._OF[kind].value(x, value, rest)
        if pseudonyms._OF[kind].number(new) == (x, size, rest):
            return new


def test_all_days_come_back():
    import datetime

    for form in ("%Y-%m-%d", "%m/%d/%Y", "%d.%m.%Y"):
        seen = set()
        for k in range(0, 73_049, 11):
            value = (datetime.date(1900, 1, 1) + datetime.timedelta(k)).strftime(form)
            new = pseudonyms.pseudonym("date", value, KEY)
            assert new == plain("date", value) and pseudonyms.pseudonym("date", new, KEY, True) == value
            seen.add(new)
        assert len(seen) == len(range(0, 73_049, 11))


def test_telephone_numbers_stay_linked_for_all_country_codes():
    for code in [str(k) for k in (1, 7, 20, 34, 49, 86, 98)] + [str(k) for k in (211, 351, 420, 599, 670, 852, 971, 998)]:
        own = [pseudonyms.pseudonym("phone", v, KEY) for v in (f"+{code} 912345678", f"+{code}912345678", f"+{code}-912-345-678")]
        digits = {re.sub("[^0-9]", "", v) for v in own}
        assert len(digits) == 1 and digits.pop().startswith(code)
        assert pseudonyms.pseudonym("phone", own[0], KEY, True) == f"+{code} 912345678"
    for code in range(1, 1000):
        value = f"+{code}55512345"
        new = pseudonyms.pseudonym("phone", value, KEY)
        assert len(new) == len(value) and pseudonyms.pseudonym("phone", new, KEY, True) == value


def test_digits_of_other_scripts_stay():
    arabic = str.maketrans("0123456789", "٠١٢٣٤٥٦٧٨٩")
    for value in (CARD, "2024-02-29", "+1 217 555 7713", "123-45-6789"):
        text = f"x {value.translate(arabic)} y"
        assert pseudonyms.rewrite(text, KEY)[0] == text


def test_a_table_against_plain_search(spark, rng, prose):
    """Every value stands alone in its text, so a plain list of them says what must come out."""
    makers = {
        "card": lambda: (lambda body: next(body + k for k in "0123456789" if pseudonyms.luhn(body + k)))(f"4{rng.randrange(10**14):014d}"),
        "date": lambda: f"{rng.randint(1950, 2050)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
        "phone": lambda: f"+{rng.choice([1, 44, 351])} {rng.randrange(10**8, 10**9)}",
        "ssn": lambda: f"{rng.randint(1, 665):03d}-{rng.randint(1, 99):02d}-{rng.randint(1, 9999):04d}",
        "ip": lambda: ".".join(str(rng.randrange(256)) for _ in range(4)),
        "email": lambda: f"{rng.choice('abcxyz')}{rng.randrange(10**7)}@mail.example",
    }
    rows = []
    for k in range(300):
        parts, want = [prose(rng.randint(1, 9))], [None]
        for _ in range(rng.randint(0, 4)):
            kind = rng.choice(list(makers))
            value = makers[kind]()
            parts += [value, prose(rng.randint(1, 9))]
            want += [(kind, value), None]
        rows.append((k, " ".join(parts), " ".join(plain(*w) if w else p for p, w in zip(parts, want, strict=True))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, want string")
    out = docs.select("text", "want", pseudonyms.pseudonymise(F.col("text"), KEY)["text"].alias("new"))
    out = out.withColumn("back", pseudonyms.pseudonymise(F.col("new"), KEY, back=True)["text"]).collect()
    assert all(r.new == r.want and r.back == r.text for r in out)


def test_learning_reads_a_repeated_id_once(spark, prose, rng):
    rows = spark.createDataFrame(marked(prose, rng, 300), "doc_id bigint, text string, toxic int")
    once = toxicity.fit(rows, rows.select("doc_id", "toxic"))
    twice = rows.union(rows.where("doc_id < 20")).union(rows.where("doc_id < 20"))
    again = toxicity.fit(twice, rows.select("doc_id", "toxic"))
    assert (once[0] == again[0]).all() and (once[1] == again[1]).all()


def test_weights_are_those_of_plain_ftrl(spark, prose, rng):
    """The fitted weights against FTRL-proximal written out, one coordinate at a time in dictionaries."""
    import math

    import pyarrow as pa

    data = marked(prose, rng, 120)
    rows = spark.createDataFrame(data, "doc_id bigint, text string, toxic int")
    slots, weights = toxicity.fit(rows, rows.select("doc_id", "toxic"))
    order = [r.doc_id for r in rows.orderBy(F.xxhash64("doc_id", "text")).collect()]
    lists = dict(zip([i for i, _, _ in data], toxicity.feature_slots(pa.array([t for _, t, _ in data])).to_pylist(), strict=True))
    labels = {i: y for i, _, y in data}
    bias, z, n = 1 << toxicity.BITS, {}, {}

    def weight(k):
        l1 = 0 if k == bias else toxicity.L1
        zk = z.get(k, 0.0)
        if abs(zk) <= l1:
            return 0.0
        return (math.copysign(l1, zk) - zk) / ((toxicity.BETA + math.sqrt(n.get(k, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for i in order:
            own = [*lists[i], bias]
            w = [weight(k) for k in own]
            g = 1 / (1 + math.exp(-min(35, max(-35, sum(w))))) - labels[i]
            for k, wk in zip(own, w, strict=True):
                z[k] = z.get(k, 0.0) + g - (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / toxicity.ALPHA * wk
                n[k] = n.get(k, 0.0) + g * g
    want = {k: weight(k) for k in z if weight(k)}
    assert set(want) == set(slots.tolist())
    assert max(abs(want[k] - w) for k, w in zip(slots.tolist(), weights.tolist(), strict=True)) < 1e-6


@pytest.mark.parametrize("size", [2, 3, 7, 100, 898 * 99 * 9999])
def test_feistel_is_a_permutation(size):
    some = range(size) if size < 1000 else range(0, size, size // 500)
    there = [pseudonyms.feistel(x, size, KEY, "t") for x in some]
    assert len(set(there)) == len(there) and all(0 <= y < size for y in there)
    assert [pseudonyms.feistel(y, size, KEY, "t", True) for y in there] == list(some)


def test_pseudonyms_of_messy_rows(spark, messy, nothing):
    docs = messy.union(messy.limit(1).withColumn("text", F.lit("card 4111111111111111 4111111111111112 é")))
    out = docs.select("text", pseudonyms.pseudonymise(F.col("text"), KEY).alias("r"))
    back = out.select("text", pseudonyms.pseudonymise(F.col("r.text"), KEY, back=True).alias("b"), "r").collect()
    assert all(r.text == r.b.text for r in back)
    assert sum(r.r.card for r in back) == 1 and any(r.text is None for r in back)
    assert nothing.select(pseudonyms.pseudonymise(F.col("text"))["text"]).count() == 0
