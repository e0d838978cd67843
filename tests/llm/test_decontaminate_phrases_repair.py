"""Decontamination, phrases and conversation repair against plain versions, and their edge cases."""

import collections
import hashlib
import itertools
import re
import tracemalloc
import types
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
EXTRA = "row long, window string, win long, item string, span int, print long, batch long, id long, f long, n long, pos long, gone boolean, fault int, audit string, _conv long"


def with_clashes(df):
    return df.selectExpr("*", *[f"cast(NULL AS {t}) AS {n}" for n, t in (c.split() for c in EXTRA.split(", "))])


# ------------------------------------------------------------- decontamination
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_report(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = WORD.findall(ascii_lower(text))
        n = min(len(w), 10)
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i:i + n])].add(item)
    out = []
    for doc, text in docs:
        w = WORD.findall(ascii_lower(text))
        hit, named = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    named |= windows[tuple(w[i:i + n])]
        names = sorted(str(x) for x in named if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


ITEM = "One two three four five six seven eight nine ten eleven twelve thirteen"
ITEMS = [(1, ITEM), (1, ITEM), (10, "alpha Beta"), (9, "solo"), (2, None), (3, ""), (4, " . - "), (5, "six seven eight nine ten eleven twelve thirteen fourteen fifteen"),
         (None, "nameless words of an item"), (6, "É été"), (7, "x x x x x x x x x x x x"), (8, "a-b c")]
DOCS = [(1, ITEM), (1, ITEM), (2, None), (None, "before " + ITEM.upper() + " after"), (3, ""), (4, "!!"), (5, "alpha, BETA; alpha beta solo"), (6, "nameless words of an item here"),
        (7, "one two three four five six seven eight nine"), (8, "two three four five six seven eight nine ten eleven twelve"), (9, "É été é ÉTÉ"), (10, "x " * 3000), (11, "x " * 9 + "y " + "x " * 10),
        (12, "A B C"), (13, "é" * 70000), (14, "five six seven eight nine ten eleven twelve thirteen fourteen fifteen five"), (15, "word " * 20000 + ITEM)]


@pytest.fixture(scope="module")
def tables(spark):
    return (with_clashes(spark.createDataFrame(DOCS, "doc_id long, text string")),
            with_clashes(spark.createDataFrame(ITEMS, "item_id long, text string").withColumnRenamed("item_id", "key")).drop("item").withColumnRenamed("key", "item_id"))


@pytest.mark.parametrize("prints", [500_000, 0])
def test_decontamination_against_all_windows(tables, prints, monkeypatch):
    from vigil.llm import decontaminate as D
    monkeypatch.setattr(D, "BROADCAST_PRINTS", prints)
    rows = [tuple(r) for r in D.report(*D.decontaminate(*tables)).collect()]
    assert sorted(rows, key=str) == plain_report(DOCS, ITEMS)


def test_decontamination_of_empty_tables(tables):
    from vigil.llm.decontaminate import decontaminate, report
    docs, items = tables
    assert report(*decontaminate(docs.limit(0), items)).count() == 0
    rows = report(*decontaminate(docs, items.limit(0))).collect()
    assert len(rows) == len(DOCS) and not any(r.contaminated or r.n_hit or r.n_items for r in rows)


def test_decontamination_has_no_python_worker(spark, tables):
    from vigil.llm.decontaminate import decontaminate, report
    plan = report(*decontaminate(*tables))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --------------------------------------------------------------------- phrases
@pytest.mark.parametrize("n, width", [(2, 1), (2, 17), (2, 32), (3, 5), (3, 32), (4, 9), (4, 32)])
def test_filters_keep_what_they_are_given(n, width):
    from vigil.llm import cqf
    dice, bits = np.random.default_rng(n * 100 + width), cqf.bits_of(n, width)
    ids = [dice.integers(0, 1 << width, 2000, dtype=np.uint64) for _ in range(n)]
    want = collections.Counter(zip(*[x.tolist() for x in ids]))
    high, low = cqf.scramble(*cqf.pack(ids, width), bits)
    order, starts = cqf.ordered(high, low, bits)
    counts = np.diff(np.append(starts, len(order))) * np.where(np.arange(len(starts)) % 7 == 0, 10**12, 1)
    high, low = high[order[starts]], low[order[starts]]
    for given in (0, min(3, bits[0])):
        got, ranges = {}, (high >> np.uint64(bits[0] - given)).astype(int)
        for place in set(ranges.tolist()):
            mine = ranges == place
            a, b, c = cqf.read(cqf.build(high[mine], low[mine], counts[mine], bits, given), bits, given, place)
            assert (a == high[mine]).all() and (b == low[mine]).all() and (c == counts[mine].astype(np.uint64)).all()
            got |= dict(zip(map(tuple, cqf.unpack(*cqf.restore(a, b, bits), n, width).tolist()), c.tolist()))
        assert set(got) == set(want) and {v for v in got.values() if v < 10**12} <= set(want.values())


def test_a_merge_sorts_a_range_in_parts(monkeypatch):
    from vigil.llm import cqf, phrases
    n, width, given, many, batches = 2, 20, 2, 60_000, 20
    bits, dice, filters, want = cqf.bits_of(n, width), np.random.default_rng(7), [], collections.Counter()
    for _ in range(batches):
        high = np.uint64(1 << bits[0] - given) | dice.integers(0, 1 << 15, many, dtype=np.uint64) << np.uint64(3)
        low = dice.integers(0, 4, many, dtype=np.uint64)
        order, starts = cqf.ordered(high, low, bits)
        counts = np.diff(np.append(starts, many))
        high, low = high[order[starts]], low[order[starts]]
        want.update(dict(zip(zip(high.tolist(), low.tolist()), counts.tolist())))
        filters.append(cqf.build(high, low, counts, bits, given))
    group = pd.DataFrame({"slice": 1, "batch": range(batches), "filter": filters})
    held, join = [], types.SimpleNamespace(groupBy=lambda _: types.SimpleNamespace(applyInPandas=lambda f, _: f))
    found = []
    for keys in (1 << 40, 1 << 16):  # all at once, in parts
        monkeypatch.setattr(phrases, "PART_KEYS", keys)
        tracemalloc.start()
        out = phrases.merge(join, n, width, given, 11)(group)
        held.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        told, frequent = out[out["batch"].notna()], out[out["batch"].isna()]
        found.append((told["bits"].tolist(), {tuple(i): int(f) for i, f in zip(frequent["ids"], frequent["f"])}))
    named = lambda k: tuple(cqf.unpack(*cqf.restore(*(np.array([x], np.uint64) for x in k), bits), n, width)[0].tolist())
    assert found[0] == found[1] and found[0][1] == {named(k): f for k, f in want.items() if f >= 11}
    assert held[1] < 0.75 * held[0] and held[1] < 48 * many * batches


def plain_phrases(docs, least):
    counts, sums = collections.Counter(), collections.Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            sums[lang] += len(w)
            for n in range(1, 5):
                counts.update((lang, *w[i:i + n]) for i in range(len(w) - n + 1))
    found = {g: f for g, f in counts.items() if len(g) > 2 and f >= least}
    out = collections.defaultdict(list)
    for (lang, *w), a in found.items():
        cuts = [((2000000 * a) // (counts[lang, *w[:k]] + counts[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        around = [f for (la, *x), f in found.items() if la == lang and len(x) > len(w) and any(x[i:i + len(w)] == w for i in range(len(x)))]
        if not any(100 * f >= 80 * a for f in around):
            out[lang].append((-score, -a, " ".join(w).encode(), counts[lang, *w[:k]], counts[lang, *w[k:]]))
    return {(lang, i + 1, p.decode(), -a, x, y, sums[lang], -s) for lang, rows in out.items() for i, (s, a, p, x, y) in enumerate(sorted(rows))}


PHRASED = [("the quick Brown fox. the quick brown fox, the quick\tbrown  dog", "en"), ("the quick brown fox\nruns far away; far away runs the quick", "en"), ("Étude É étude É étude É", "fr"), (None, "fr"), ("", None),
           ("a b a b a b a b a b", None), ("x\x1cy x\x1cy z x\x1cy z \x00 w \x00 w", "und"), ("q " * 5000, "xx"), ("日本 日本 日本 語", "ja")] * 2


@pytest.mark.parametrize("range_keys", [1 << 22, 40])
def test_phrases_against_plain_counts(spark, range_keys):
    from vigil.llm.phrases import frequent_phrases, report
    df = with_clashes(spark.createDataFrame(PHRASED, "text string, lang string")).repartition(3)
    rows = {tuple(r) for r in report(*frequent_phrases(df, least=3, range_keys=range_keys), top=10**6).collect()}
    assert rows == plain_phrases(PHRASED, 3) and {r[0] for r in rows} >= {"en", "fr", "ja", "und", "xx"}


def test_phrases_of_an_empty_table_and_of_rare_words(spark):
    from vigil.llm.phrases import frequent_phrases, report
    df = spark.createDataFrame(PHRASED, "text string, lang string")
    assert report(*frequent_phrases(df.limit(0))).count() == 0
    assert report(*frequent_phrases(df, least=10**6)).count() == 0


def test_a_batch_of_one_text_ends_phrases_at_its_ends(spark):
    from vigil.llm.phrases import BREAK, words_and_breaks
    assert words_and_breaks([b"A b", b"", b"c.D"]) == [b"a", b"b", BREAK, BREAK, b"c", BREAK, b"d"]


# ---------------------------------------------------------------------- repair
LEGAL = re.compile(r"(s?(ua)+)?")


def plain_edits(rows):
    """The cheapest (cost, audit) by trying every sequence of edits, in order of cost."""
    best = None
    for extra in range(len(rows) + 3):
        for where in itertools.combinations_with_replacement(range(len(rows) + 1), extra):
            for how in itertools.product("KRD", repeat=len(rows)):
                slots, audit, cost = [], "", 0
                for i in range(len(rows) + 1):
                    slots += [("ua", "I")] * where.count(i)
                    audit += "I" * where.count(i)
                    if i < len(rows):
                        initial, fault = rows[i]
                        audit += how[i]
                        if how[i] == "D":
                            cost += 3
                            continue
                        if fault in (1, 2):
                            cost = 10**6
                        cost += (fault == 3) + 2 * (how[i] == "R")
                        slots.append((initial if how[i] == "K" else "ua", how[i]))
                cost += 2 * extra
                if (best is None or (cost, audit) < best) and any(LEGAL.fullmatch("".join(x)) for x in itertools.product(*[s for s, _ in slots])):
                    best = (cost, audit)
        if best and best[0] <= 2 * extra:
            break
    return best


def test_parser_against_all_edits():
    from vigil.llm.repair import Parser
    dice = np.random.default_rng(5)
    cases = [()] + [tuple(("suax"[dice.integers(4)], [0, 0, 1, 2, 3][dice.integers(5)]) for _ in range(dice.integers(1, 5))) for _ in range(120)]
    for rows in cases:
        parser = Parser()
        for row in rows:
            parser.read(*row)
        assert parser.result() == plain_edits(rows), rows


def plain_repair(rows):
    """Independent of the operator: damage, faults, cheapest edits by a search over grammar states, and the digest."""
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        mine = convs[conv]
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        mine += [(turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            body = text.strip(" \t\n\x0b\x0c\r")
            faults.append(1 if not body else 2 if (role, text) in seen else 3 if body[-1] not in ".!?" else 0)
            seen.add((role, text))
        best = {"": (0, "", ())}

        def insert():
            for _ in range(4):
                for state in list(best):
                    for x in follows[state]:
                        if x != "s":
                            cost, audit, turns = best[state]
                            new = (cost + 2, audit + "I", (*turns, ({"u": "user", "a": "assistant"}[x], "")))
                            best[x] = min(best.get(x, new), new)
        for (_, role, text), fault in zip(mine, faults):
            insert()
            new = collections.defaultdict(list)
            for state, (cost, audit, turns) in best.items():
                new[state].append((cost + 3, audit + "D", turns))
                if fault in (0, 3):
                    for x in follows[state]:
                        if role[:1] == x:
                            new[x].append((cost + fault // 3, audit + "K", (*turns, (role, text))))
                        elif x != "s":
                            new[x].append((cost + 2 + fault // 3, audit + "R", (*turns, ({"u": "user", "a": "assistant"}[x], text))))
            best = {s: min(paths) for s, paths in new.items()}
        insert()
        cost, audit, turns = min(best[s] for s in ("", "a") if s in best)
        known = {t for t, _, _ in mine if t is not None}
        first = [r[:1] for _, r, _ in mine]
        out.append((conv, max(known) - min(known) + 1 - len(known) if known else 0, *(faults.count(i) for i in (1, 2, 3)), sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()))
    return sorted(out, key=str)


def op13_rows(df):
    from vigil.llm import repair as R
    from pyspark.sql import functions as F
    faulty, audit = R.repair(R.damaged(df))
    digest = R.repaired(faulty, audit, digest=True).withColumnRenamed("conv_id", "_c")
    return sorted((tuple(r) for r in audit.join(digest, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c").collect()), key=str)


def test_repair_of_whole_table(spark):
    from vigil.llm.repair import op13_conversation_repair
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    got = sorted((tuple(r) for r in op13_conversation_repair(spark, SF).collect()), key=str)
    assert got == plain_repair(rows)


ODD = [(None, None, None, None), (None, 1, "user", "Hi."), (None, 2, "assistant", "Hello?  \n"), (1, 0, "user", ""), (1, 0, "user", "Same."), (1, 0, "user", "Same."), (1, None, "tool", "What!"), (2, 5, "assistant", "No\u0085"),
       (3, 7, "User", "x."), (3, 9, "", "y."), (4, 0, "system", "s."), (4, 1, "system", "s2."), (4, 2, "assistant", "long " * 20000 + "."), (6, 2**62, "user", "Big."), (6, -2**62, "assistant", "Small.")]
ODD += [(7, i, "user" if i % 3 else "assistant", f"t{i}." if i % 5 else "cut") for i in range(600)] + [(100 + i, 0, "user", "Gone or not.") for i in range(60)]


def test_repair_of_odd_rows(spark):
    df = with_clashes(spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string"))
    got = op13_rows(df)
    want = [(r[0], min(r[1], 2**63 - 1), *r[2:]) for r in plain_repair(ODD)]
    assert got == sorted(want, key=str)
    assert {r[0] for r in got} == {r[0] for r in ODD} and any(r[7] == "" and r[6] == 0 for r in got)
    assert op13_rows(df.limit(0)) == []


def test_repaired_turns_are_well_formed(spark):
    from vigil.llm import repair as R
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    turns = collections.defaultdict(list)
    for r in R.repaired(*R.repair(R.damaged(df))).collect():
        turns[r.conv_id].append((r.place, r.role))
    assert turns and all(LEGAL.fullmatch("".join(role[0] for _, role in sorted(t))) and [p for p, _ in sorted(t)] == list(range(len(t))) for t in turns.values())
    faulty, audit = R.repair(R.intact(df))
    assert faulty.where("gone").count() == 0 and audit.count() == df.select("conv_id").distinct().count()
