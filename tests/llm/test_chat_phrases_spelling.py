"""Chat formatting, phrase mining and spelling variants against plain versions."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as contract
from arborlog.llm import collocations as C
from arborlog.llm import queries
from arborlog.llm import spelling as S
from arborlog.llm.chat_format import format_turns, read_examples, read_turns, rendered
from checks.compare import connect, differences

SMALL = "/root/testdata/sf0.001"
TURNS = "turn long, conv_id long, place string, role string, text string, formatted string"
HARD = ["", "### user: ", "</turn>\n", "\\", "\\\\#", "#<\\", "\\### Assistant: </turn> ok", "日本 ####\n", "a: b", None, "\\.", ": "]


def turns_of(spark, rows):
    return spark.createDataFrame([(t, c, "x", r, s, "y") for c, t, r, s in rows], TURNS).repartition(3)


def plain_turn(role, text):
    def esc(s):
        return re.sub(r"([\\#<])", r"\\\1", s)

    return f"### {esc(role).replace(':', chr(92) + '.')}: {esc(text)}</turn>\n"


def test_chat_round_trip_and_examples(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(HARD)]
    rows += [(2, i, r, "role") for i, r in enumerate(["a:b", "\\", "\\.", None, "", "</turn>", "\\:\\"])]
    rows += [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (3, None, "user", "no turn"), (3, 5, "assistant", "x"), (3, 5, "assistant", "x")]
    rows += [(4, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(-1500, 3000, 3)]
    formatted = format_turns(turns_of(spark, rows)).cache()
    by_conv, examples = defaultdict(list), {}
    for r in read_turns(formatted).collect():
        by_conv[r.conv_id].append(r)
    for r in rendered(formatted).collect():
        examples[r.conv_id, r.place] = r
    want = defaultdict(list)
    for c, t, r, s in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or "")):
        want[c].append((r or "", s or ""))
    assert set(by_conv) == set(want)
    for c, turns in want.items():
        own, text = sorted(by_conv[c], key=lambda r: r.place), ""
        assert [(r.role, r.text) for r in own] == turns and [r.place for r in own] == list(range(len(own)))
        for r, (role, said) in zip(own, turns):
            assert (r.start, r.formatted, r.chars) == (len(text), plain_turn(role, said), len(r.formatted))
            text += r.formatted
            if role == "assistant":
                e = examples[c, r.place]
                assert (r.loss_text, e.example, r.example_chars, r.context_turns) == (said, text, len(text), r.place)
                assert text[e.loss_start : e.loss_end] == re.sub(r"([\\#<])", r"\\\1", said)
            else:
                assert r.loss_text is None and r.example_chars is None and (c, r.place) not in examples
    formatted.unpersist()


def test_query_reads_written_examples(spark, tmp_path, monkeypatch):
    rows = [(1, 0, "user", "a</turn>"), (1, 1, "assistant", "b#"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e"), (2, 0, "user", "f")]
    turns_of(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    tables = {}

    def kept(df, name):
        tables[name] = df.cache()
        return tables[name]

    monkeypatch.setattr(queries, "written", kept)
    found = {r.conv_id: r for r in queries.op11_prefix_target_chat(spark, str(tmp_path)).collect()}
    examples = sorted(tables["chat-examples"].filter("conv_id = 1").collect(), key=lambda r: r.place)
    whole = [plain_turn(r, t) for _, _, r, t in rows]
    assert [e.example for e in examples] == ["".join(whole[:2]), "".join(whole[:4])]
    read = read_examples(tables["chat-examples"]).filter("conv_id = 1").orderBy("place").collect()
    assert [(r.context, r.loss_text) for r in read] == [(whole[0] + "### assistant: ", "b#"), ("".join(whole[:3]) + "### assistant: ", "d")]
    assert (found[1].n_turns, found[1].n_examples, found[1].loss_chars) == (5, 2, 3)
    assert found[1].examples_chars == sum(len(e.example) for e in examples) and found[1].formatted_chars == sum(map(len, whole[:5]))
    assert (found[2].n_turns, found[2].n_examples, found[2].loss_chars, found[2].examples_chars) == (1, 0, 0, 0)
    for table in tables.values():
        table.unpersist()


def test_chat_of_no_rows(spark):
    empty = format_turns(spark.createDataFrame([], TURNS))
    assert empty.count() == 0 and read_turns(empty).count() == 0 and rendered(empty).count() == 0


def plain_phrases(docs, least, top):
    counts, totals = Counter(), Counter()
    for text, lang in docs:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, 5):
                counts.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    found = defaultdict(list)
    candidates = {k: a for k, a in counts.items() if len(k[1]) > 1 and a >= least}
    around = defaultdict(int)
    for (lang, w), a in candidates.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                around[lang, w[i : i + m]] = max(around[lang, w[i : i + m]], a)
    for (lang, w), a in candidates.items():
        if 100 * around[lang, w] < 80 * a:
            cuts = [(2000000 * a // (counts[lang, w[:k]] + counts[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found[lang].append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for lang, rows in found.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])}


def test_phrases_against_a_plain_count(spark):
    import random

    rng = random.Random(4)
    words = ["The", "of", "river", "ÉCOLE", "école", "日本", "data set", "x\x00y", "model", "a"]
    docs = [(" ".join(rng.choices(words, [9, 7, 5, 3, 3, 2, 2, 1, 1, 1], k=rng.randint(0, 60))) + rng.choice([". ", ",\t", "\r\n", " ! "]) + "new york city hall", rng.choice(["en", "de", None])) for _ in range(120)]
    docs += [(None, "en"), ("", "en"), ("...", "fr"), ("of " * 3000, "es"), (" \t\n", None), docs[0], docs[0]]
    table = spark.createDataFrame([(t, g, "p", 1) for t, g in docs], "text string, lang string, phrase string, n int").repartition(3)
    for least, top in ((3, 2000), (5, 7)):
        got = {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in C.collocations(table, min_count=least, top=top).collect()}
        assert got == plain_phrases(docs, least, top) and got
    assert C.collocations(table.limit(0)).count() == 0


def test_small_batches_are_counted_together_and_leave_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "STRIPES", 3)
    texts = [f"a{i % 5} b{i % 3} a{i % 5}" for i in range(40)] + [None, ""]
    seen = []
    batches = (seen.append(i) or pa.record_batch([pa.array(["en"]), pa.array([t], pa.string())], ["lang", "text"]) for i, t in enumerate(texts))

    class All:
        value = np.full(1 << (C.FILTER_BITS - 6), (1 << 64) - 1, np.uint64)

    out = list(C._counter(2, All)(batches))
    assert [b.num_rows for b in out] == [3, 3, 2] and len(seen) == len(texts)  # a prefix is one stripe, whatever the batches
    rows = [r for b in out for r in b.to_pylist()]
    assert {(r["prefix"], w): n for r in rows for w, n in zip(r["next"], r["n"])} == Counter(p for t in texts if t for p in zip(t.split(), t.split()[1:]))

    name, given = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with C._small_batches(spark):
        sizes = spark.range(2000).coalesce(1).mapInArrow(lambda bs: (pa.record_batch([pa.array([b.num_rows])], ["n"]) for b in bs), "n long").collect()
        assert [r.n for r in sizes] == [C.TEXTS] * 4
    assert spark.conf.get(name) == given


def test_words_are_hashed_for_the_filter_alone_and_once(monkeypatch):
    words, places, hashed, looked_up = C._word_hash, C._maybe, [], []
    monkeypatch.setattr(C, "_word_hash", lambda names: hashed.append(len(names)) or words(names))
    monkeypatch.setattr(C, "_maybe", lambda filter_, h: looked_up.append(len(h)) or places(filter_, h))
    every = np.full(1 << (C.FILTER_BITS - 6), (1 << 64) - 1, np.uint64)
    texts, langs = [b"a b  a b c\nb a", b"", b"c", b" a b "], ["x", "x", "y", "y"]
    assert C._Tokens(langs, texts).stripes(1, None).num_rows == 2 and not hashed
    for length in (2, 3, 4):
        looked_up.clear()
        found = C._Tokens(langs, texts).stripes(length, every)
        want = Counter()
        for lang, text in zip(langs, texts):
            for piece in text.split(b"\n"):
                of = piece.decode().split()
                want.update((lang, " ".join(of[i : i + length - 1]), of[i + length - 1]) for i in range(len(of) - length + 1))
        stripes = zip(*(c.to_pylist() for c in found.columns))
        assert {(lang, prefix, w): n for lang, prefix, ws, ns in stripes for w, n in zip(ws, ns)} == want
        # Each phrase of one word less is looked up once.
        assert looked_up == [sum(max(0, len(p.split()) - length + 2) for t in texts for p in t.split(b"\n"))]


def test_long_texts_are_taken_in_parts_that_end_with_a_piece(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(C, "PART_BYTES", 16)
    texts = ["one two three four, five six. seven", "eight nine", "no end " * 9, None, ""]
    parts = list(C._parts(list("abcde"), pa.array(texts)))
    assert len(parts) == 3
    joined = defaultdict(bytes)
    for langs, some in parts:
        for lang, raw in zip(langs, some):
            joined[lang] += raw
    assert dict(joined) == {"a": b"one two three four\n five six\n seven", "b": b"eight nine", "c": b"no end " * 9}


def plain_forms(docs, edit, least=7):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            counts[edit(doc_id, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run))] += 1
    n = {w: k for w, k in counts.items() if len(w) >= least and k >= 2}
    patterns, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            patterns[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for same in patterns.values():
        for w in same:
            near[w] |= same - {w}
    form = {w: min(near[w], key=lambda v: (-n[v], v)) for w in n if near[w]}
    form = {w: f for w, f in form.items() if n[f] >= 10 * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root(w)) for w in n}


def rows_of(df):
    return {(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def plain_deletion(doc_id, run):
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    return run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]


def test_spelling_against_a_plain_search(spark):
    import random

    rng = random.Random(8)
    base = ["".join(rng.choices("abcdeÉßÿ", k=rng.randint(6, 12))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "abcdefg", "abcdegf", "x" * 6000]

    def slip(w):
        i, c = rng.randrange(len(w)), rng.choice("abcé")
        return rng.choice([w, w, w, w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])

    docs = [(i, " ".join(slip(rng.choice(base[: 1 + i % len(base)])).swapcase() for _ in range(60)) + "1" + base[-1]) for i in range(150)]
    docs += [(None, None), (150, ""), (151, "1 2 3"), (0, docs[0][1]), (152, base[-1][:-1] + " " + base[-1][:-1])]
    table = spark.createDataFrame([(i, t, "w", 7) for i, t in docs], "doc_id long, text string, word string, n int").repartition(3)
    words = S.word_counts(table, edit=S.delete_some)
    assert rows_of(S.spelling_forms(words)) == plain_forms(docs, plain_deletion)
    assert rows_of(S.spelling_forms(S.word_counts(table, min_length=5))) == plain_forms(docs, lambda _, run: run, 5)
    assert S.spelling_forms(S.word_counts(table.limit(0))).count() == 0


def test_words_of_one_block_in_many_chunks(spark, monkeypatch):
    # Chunks of two words, and one chunk a slice: every way through the meeting is taken.
    monkeypatch.setattr(S, "CHUNK", 2)
    monkeypatch.setattr(S, "CHUNKS_TOGETHER", 1)
    import itertools

    words = [("".join(p) + "aaaa", 2 + i * i) for i, p in enumerate(itertools.product("afk", repeat=3))] + [("aaaaaa", 50), (None, 3)]
    table = spark.createDataFrame(words, "word string, n long")
    got = {(r.word, r.n_near) for r in S.spelling_forms(table).collect()}
    given = [w for w, _ in words if w]
    want = {(w, sum(sum(a != b for a, b in zip(w, v)) == 1 if len(v) == len(w) else v in {w[:i] + w[i + 1 :] for i in range(len(w))} or w in {v[:i] + v[i + 1 :] for i in range(len(v))} for v in given if v != w and abs(len(v) - len(w)) <= 1)) for w in given}
    assert got == want


@pytest.mark.parametrize("name", ["op11_prefix_target_chat", "op12_stripe_phrases"])
def test_registered_queries_against_their_sql(spark, name):
    assert differences(contract.queries()[name](spark, SMALL), connect(SMALL), contract.oracle_sql()[name]) == []


def test_registered_spelling_query(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    assert rows_of(contract.queries()["op13_spelling_gram"](spark, SMALL)) == plain_forms(docs, plain_deletion)
