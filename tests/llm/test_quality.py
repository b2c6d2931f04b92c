"""Quality rules against a plain per-document version, and line frequency on planted hosts."""

import re
from collections import Counter

from vacantia.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
        len(covered),
    )


def test_query_equals_brute_force(spark, folder, documents):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op7_quality_rules"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, _ in documents:
        r, want = rows[doc_id], brute(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])


def test_measures_of_odd_texts():
    for text in ("", " \n\n ", "a", "a b c a b c", "a a a a", "x y z \x1c b", "l\nl\n \nl", "a b\r\na b\r\n"):
        assert quality.measure_text(text)[:5] == brute(text), text


def _words(tag, n):
    """Different words without digits, which normalising would make alike."""
    text = " ".join(f"{tag}{i}x{i * 7 % 13}" for i in range(n))
    return text.translate(str.maketrans("0123456789", "abcdefghij"))


def test_furniture_lines_reject_depleted_documents(spark, make):
    menu = "\n".join(_words(f"menu{k}", 20) for k in range(3))
    rows = [(i, f"{menu}\n{_words(f'own{i}', 5)}", "site") for i in range(150)]
    rows += [(1000 + i, f"{_words('menu0', 20)}\n{_words(f'page{i}', 80)}", "site") for i in range(150)]
    rows += [(3000, menu, "elsewhere")]
    kept = {r["id"]: r["kept"] for r in quality.judge(make(rows)).collect()}
    assert not any(kept[i] for i in range(150))
    assert all(kept[1000 + i] for i in range(150)) and kept[3000]


def test_copies_are_not_furniture(spark, make):
    text = "\n".join(_words(f"line{k}", 30) for k in range(4))
    edited = [text.replace("lineaa", f"line{chr(107 + i % 10)}{chr(97 + i)}") for i in range(20)]
    rows = [(i, text, "site") for i in range(100)] + [(200 + i, t, "site") for i, t in enumerate(edited * 3)]
    assert all(r["kept"] for r in quality.judge(make(rows)).collect())


def test_odd_rows(spark, make):
    long = _words("w", 30_000)
    rows = [(1, None, "a"), (2, "", None), (3, long, None), (3, long, None), (None, long, "b")]
    frame = make(rows, extra=("kept", "key", "host", "row_key"))
    out = quality.judge(frame).collect()
    assert Counter((r["id"], r["kept"]) for r in out) == Counter({(1, False): 1, (2, False): 1, (3, True): 2, (None, True): 1})
    good = quality.keep_good(frame)
    assert good.columns == frame.columns and good.count() == 3
    assert quality.judge(make([])).collect() == []


def test_many_furniture_lines_with_few_own_words(spark, make):
    menus = {h: "\n".join(_words(f"{h}menu{k}x", 5) for k in range(20)) for h in ("p", "q", "r", "s")}
    rows = [
        (1000 * k + i, f"{menu}\n{_words(f'{h}own{i}x', 10)}", h) for k, (h, menu) in enumerate(menus.items()) for i in range(300)
    ]
    got = {r["id"]: r for r in quality.judge(make(rows)).collect()}
    assert all(got[1000 * k + i]["removed_words"] == 100 and not got[1000 * k + i]["kept"] for k in range(4) for i in range(300))


def test_edited_copies_of_a_text_count_once(spark, make):
    lines = [_words(f"line{k}x", 40) for k in range(8)]
    rows = []
    for i in range(120):
        own = list(lines)
        own[i % 8] = own[i % 8].replace(own[i % 8].split()[20], _words(f"new{i}x", 1))
        rows.append((i, "\n".join(own), "site"))
    got = quality.judge(make(rows)).collect()
    assert len(got) == 120 and all(r["kept"] and r["removed_words"] == 0 for r in got)


def test_furniture_lines_leave_kept_texts(spark, make):
    cookie, letter = "We use cookies to 3 ends", "Sign up for our  Newsletter"
    own = {i: _words(f"own{i}x", 80) for i in range(100)}
    rows = [(i, f"{cookie}\n\n{t}\n{letter.upper() if i % 2 else letter}\n \nend {_words(f'more{i}x', 30)}", "site") for i, t in own.items()]
    rows += [(200 + i, f"{cookie}\n{_words(f'far{i}x', 80)}", f"lone{i}") for i in range(30)]
    frame = make(rows + rows[:2], extra=("key", "removed_lines", "row_lines"))
    good = quality.keep_good(frame)
    got = Counter((r["doc_id"], r["text"]) for r in good.collect())
    want = Counter((i, f"\n{own[i]}\n \nend {_words(f'more{i}x', 30)}" if i < 200 else t) for i, t, _ in rows + rows[:2])
    assert got == want and good.columns == frame.columns


def test_cut_lines_and_measures_name_lines_alike():
    for text in ("", "A  1\n\tb\r\n\n a 22 ", "x\x0by\nX Y", "\u0130 i\n\u00df\n"):
        assert not re.search(r"[^\s]", quality.cut_lines(text, quality.measure_text(text)[5])), text
        assert quality.cut_lines(text, []) == text


def test_memory_follows_slices_and_written_rows_hold_no_pairs(spark, make, monkeypatch):
    """Word pairs are found for documents with a furniture line only, a slice of texts at a time."""
    import pyarrow as pa

    rows = [(i, f"We use cookies\n{_words(f'own{i}x', 60)}") for i in range(1000)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(1000), pa.int64()), pa.array(range(1000), pa.int64()), pa.array(["s"] * 1000), pa.array([t for _, t in rows])],
        ["key", "id", "host", "text"],
    )
    out = list(quality._measure_batches([batch, batch.slice(0, 0)]))
    assert max(b.num_rows for b in out) <= 256 and sum(b.num_rows for b in out) == 1000
    assert "pairs" not in out[0].schema.names

    written = {}
    real = quality.settle

    def settle(frame, label):
        written[label] = real(frame, label)
        return written[label]

    monkeypatch.setattr(quality, "settle", settle)
    lone = [(5000 + i, _words(f"lone{i}x", 60)) for i in range(300)]
    got = quality.judge(make(rows[:100] + rows[:10] + lone)).collect()
    assert sum(r["removed_words"] == 3 for r in got) == 110
    assert "pairs" not in written["quality"].columns
    bodies = written["quality-bodies"].collect()
    assert len(bodies) == 100
    want = {tuple(quality.text_pairs(t).tolist()) for _, t in rows[:100]}
    assert {tuple(r["pairs"]) for r in bodies} == want


def test_only_texts_with_a_wanted_slot_are_shuffled(spark):
    """Texts meet their keys by a shuffle at any size, and few of those that no one wants are in it."""
    rows = spark.range(20_000).selectExpr("xxhash64(id) AS key", "concat('text ', id) AS text", "id")
    wanted = rows.where("id % 100 = 0").selectExpr("'s' AS host", "id AS body", "key")
    found = quality.texts_of(rows, wanted)
    assert sorted((r.body, r.text) for r in found.collect()) == [(i, f"text {i}") for i in range(0, 20_000, 100)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search("Join LeftSemi.*strategy=broadcast", plan) and re.search("Join Inner.*strategy=merge", plan)
    slots = {r.key % quality.SLOTS for r in wanted.collect()}
    assert sum(r.key % quality.SLOTS in slots for r in rows.collect()) <= 250
