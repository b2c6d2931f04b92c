"""Line dedup against all pairs, and what it leaves of documents."""

import random
import re

from vacantia.llm import linededup, queries


def normal(line):
    return re.sub(r"[\x20\x09\x0B-\x0D]+", " ", line.lower()).strip(" ")


def shingle_set(line):
    """All runs of eight characters."""
    return {line[i:i + 8] for i in range(max(1, len(line) - 7))}


def brute(documents):
    """(members of each component, a function to a line's component) from all pairs of lines."""
    lines = sorted({normal(x) for _, text in documents for x in (text or "").split("\n")} - {""})
    sets = {x: shingle_set(x) for x in lines}
    root = {x: x for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[:i]:
            common = len(sets[a] & sets[b])
            if common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                root[find(a)] = find(b)
    members = {}
    for x in lines:
        members.setdefault(find(x), set()).add(x)
    return members, find


def _words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n)]


def test_fuzzy_lines_keep_one_of_each_component(spark, make):
    rng = random.Random(3)
    base = [_words(rng, 50) for _ in range(40)]
    docs = []
    for i in range(160):
        lines = [" ".join(_words(rng, rng.randrange(3, 20)))]
        for _ in range(3):
            own = list(rng.choice(base))
            if rng.random() < 0.6:
                own[rng.randrange(len(own))] += "x"
            lines.append("  ".join(own).title())
        docs.append((i, "\n".join(lines)))
    members, find = brute(docs)
    got = {r["id"]: set(r["removed"]) for r in linededup.report(make(docs)).collect()}
    texts = dict(docs)
    kept = {}
    for i, removed in got.items():
        for k, line in enumerate(texts[i].split("\n")):
            if k not in removed:
                kept.setdefault(find(normal(line)), []).append(i)
    assert set(kept) == set(members)
    assert all(len(v) == 1 for v in kept.values())
    # The document of the least id keeps the line.
    least = {}
    for i, text in docs:
        for line in text.split("\n"):
            least[find(normal(line))] = min(i, least.get(find(normal(line)), i))
    assert all(v == [least[c]] for c, v in kept.items())


def test_query_equals_brute_force(spark, folder, documents):
    rows = queries.QUERIES["op10_line_dedup"](spark, folder).collect()
    docs = [(i, t) for i, t, _ in documents]
    members, find = brute(docs)
    texts = dict(docs)
    assert len(rows) == len(docs)
    kept = {}
    for r in rows:
        lines = [normal(x) for x in (texts[r["doc_id"]] or "").split("\n")]
        removed = {int(x) for x in r["removed_lines"].split(",") if x}
        assert r["n_lines"] == sum(map(bool, lines)) and r["n_removed"] == len(removed)
        for k, line in enumerate(lines):
            if line and k not in removed:
                kept.setdefault(find(line), []).append(r["doc_id"])
    assert set(kept) == set(members)
    # Banding may miss a link; of these lines it misses none or nearly none.
    assert sum(len(v) > 1 for v in kept.values()) <= 0.002 * len(members)


def test_texts_that_are_left(spark, make):
    rows = [
        (1, "Head line one\n\nshared line of text\nshared line of text\n tail "),
        (2, "SHARED  line of text\nown"), (3, "shared line of text"), (4, None), (5, ""), (6, " \n\t"),
        (7, "日本語の文章がここにあります\n日本語の文章がここにないです"), (8, "日本語の文章がここにあります"),
        (9, "x " * 60_000), (9, "x " * 60_000), (None, "no id here"), (None, "no id here"),
    ]
    frame = make(rows, extra=("key", "line", "removed", "row_key"))
    out = linededup.dedup_lines(frame)
    assert out.columns == frame.columns
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in out.collect()), key=repr)
    assert got == sorted([
        (1, "Head line one\n\nshared line of text\n tail "), (2, "own"), (4, None), (5, ""), (6, " \n\t"),
        (7, "日本語の文章がここにあります\n日本語の文章がここにないです"),
        (9, "x " * 60_000), (9, "x " * 60_000), (0, "no id here"), (0, "no id here"),
    ], key=repr)
    assert linededup.dedup_lines(make([])).collect() == []


def test_a_large_bucket_is_one_component(spark, make):
    text = " ".join(_words(random.Random(5), 30))
    rows = [(i, text.replace(" ", f"{i} ", 1)) for i in range(1500)]
    assert linededup.dedup_lines(make(rows)).count() == 1


def test_lines_that_differ_between_signature_runs_are_kept(spark, make):
    pairs = [
        ("order id 123456780001", "order id 123456789999"),
        ("https://site.com/page/0001", "https://blog.com/page/0001"),
        ("iban de00111122223333444455", "iban de00111122223333449999"),
    ]
    rows = [(2 * i + k, line) for i, pair in enumerate(pairs) for k, line in enumerate(pair)]
    assert linededup.dedup_lines(make(rows)).count() == len(rows)


def test_families_within_a_large_bucket(spark, make):
    """Every line shares most of its words; those of a family are similar, those of two families are not."""
    rng = random.Random(11)
    frame = _words(rng, 14)
    families = [_words(rng, 7) for _ in range(120)]
    docs = []
    for k, own in enumerate(families):
        for copy in range(3):
            words = frame[:7] + own + frame[7:]
            docs.append((len(docs), " ".join(words[:copy * 3] + [words[copy * 3] + "q"] + words[copy * 3 + 1:])))
    members, find = brute(docs)
    assert len(members) >= 100
    kept = linededup.dedup_lines(make(docs)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(
        min(i for i, t in docs if find(normal(t)) == c) for c in members
    )


def test_lines_in_one_large_bucket_meet_without_a_leader(spark, make):
    """Lines of a bucket that are below the similarity to all its leaders, but similar to each other, two by two."""
    from pyspark.sql import functions as F

    rng = random.Random(17)
    own = [" ".join(_words(rng, 30)) for _ in range(300)]
    lines = own + [text + "q" for text in own]
    rows = make(list(enumerate(lines)))
    signed = linededup.signatures(rows).withColumn("buckets", F.array(F.lit(1).cast("long")))
    met = linededup.members(signed)
    led, texts = linededup.leaders(met), linededup.texts_of(rows, met)
    assert led.count() == linededup.LEADERS
    first = linededup.similar(linededup.led_pairs(met, led), texts, 0.8)
    roots = linededup.settle(linededup.components(first), "roots")
    rest = linededup.similar(linededup.other_pairs(met, led, roots, signed, 0.8), texts, 0.8)
    tied = linededup.components(roots.toDF("u", "v").unionByName(rest))
    assert roots.count() < 40 and tied.count() == 300


def test_runs_inside_long_words_give_candidates(spark, make):
    rng = random.Random(19)
    rows = []
    for i in range(40):
        word = "".join(rng.choice("abcdefghijklmnop") for _ in range(300))
        rows += [(2 * i, word), (2 * i + 1, "x" * (1 + i % 11) + word)]
    members, _ = brute(rows)
    assert len(members) == 40
    assert linededup.dedup_lines(make(rows)).count() == 40


def test_bitmaps_tell_no_similar_lines_apart(spark, make):
    from pyspark.sql import functions as F

    rng = random.Random(23)
    lines = ["ab" * 200, "ab" * 250, "short", "shorts", "日本語の文章", "x" * 9000, "x" * 9001]
    for size in (3, 12, 40, 160, 700):
        base = _words(rng, size)
        lines += [" ".join(base[:k] + ["zz"] + base[k + 1:]) for k in range(0, size, max(1, size // 4))] + [" ".join(base)]
    rows = make(list(enumerate(lines)))
    signed = linededup.signatures(rows)
    pairs = signed.select(F.col("line").alias("u")).crossJoin(signed.select(F.col("line").alias("v"))).where("u < v")
    texts = linededup._lines(rows)
    for similarity in (0.5, 0.8, 0.95):
        near = linededup.possible(pairs, signed, similarity)
        assert near.count() < pairs.count()
        got = {(r.u, r.v) for r in linededup.similar(near, texts, similarity).collect()}
        assert got and got == {(r.u, r.v) for r in linededup.similar(pairs, texts, similarity).collect()}


def test_lines_that_share_half_their_runs_are_told_apart_before_their_texts_are_fetched(spark, make):
    """The pairs that leave the tiles do not grow with the square of unlike lines of a bucket, and no link is lost."""
    from pyspark.sql import functions as F

    rng = random.Random(29)
    common = " ".join(_words(rng, 58))
    lines = [common + " " + " ".join(_words(rng, 22)) for _ in range(80)]
    lines += [text + "q" for text in lines[:12]]
    rows = make(list(enumerate(lines)))
    signed = linededup.settle(linededup.signatures(rows).withColumn("buckets", F.array(F.lit(1).cast("long"))), "signed")
    met = linededup.members(signed)
    led, texts = linededup.leaders(met), linededup.texts_of(rows, met)
    roots = spark.createDataFrame([], "node long, root long")
    loose = linededup.settle(linededup.other_pairs(met, led, roots, signed, 0.8), "loose")
    tight = linededup.settle(linededup.other_pairs(met, led, roots, signed, 0.8, texts), "tight")
    links = {(r.u, r.v) for r in linededup.similar(loose, texts, 0.8).collect()}
    assert links and links == {(r.u, r.v) for r in linededup.similar(tight, texts, 0.8).collect()}
    assert loose.count() > 1000 and tight.count() < 3 * len(links)


def test_runs_of_a_line_are_summed_where_it_lies(spark, make):
    """Texts are dealt by their lines once; no run is cut by a pattern or moved (the cost of a GB, F1)."""
    rows = make([(1, "one line of text\nanother line of text"), (2, "One  line of text")])
    signed = linededup.texts_once(rows).join(linededup.bands(linededup.texts_once(rows)).hint("merge"), "line")
    plan = linededup.bands(linededup.texts_once(rows))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "regexp" not in plan.replace("regexp_replace", "")
    assert signed.count() == 2
    again = signed._jdf.queryExecution().executedPlan()
    assert "regexp_extract" not in again.toString()


def test_runs_are_of_characters(spark, make):
    rng = random.Random(31)
    lines = ["a", "short", "eight ch", "日本語の文章がここにあります", "ab" * 40, "a😀b" * 9, "naïve café " * 4 + "𝒳𝒴𝒵"]
    lines += ["".join(rng.choice("ab é日😀") for _ in range(200)).strip() for _ in range(5)]
    frame = spark.createDataFrame([(x,) for x in lines], "text string")
    got = {r.text: r.n for r in frame.selectExpr("text").withColumn("n", linededup.runs(frame.text)).collect()}
    assert {x: len(set(n)) for x, n in got.items()} == {x: len(shingle_set(x)) for x in lines}
    assert all(len(n) == len(set(n)) for n in got.values())


def test_signatures_choose_among_all_runs(spark, make):
    """Few pairs at the similarity share no bucket, and few far below it share one, short lines and long."""
    rng = random.Random(37)
    for size, cut in ((14, 1), (40, 4), (220, 24)):
        lines, n = [], 150
        for _ in range(n):
            text = "".join(rng.choice("abcdefghijklmnop") for _ in range(size + 7))
            lines += [text, text[cut:] + "".join(rng.choice("qrstuvwxyz") for _ in range(cut))]
        keys = {r.text: set(r.buckets) for r in linededup.signed_texts(make(list(enumerate(lines)))).collect()}
        met = sum(bool(keys[lines[2 * i]] & keys[lines[2 * i + 1]]) for i in range(n))
        assert met >= n - 4
        assert sum(bool(keys[lines[2 * i]] & keys[lines[2 * i + 2]]) for i in range(n - 1)) == 0


def test_wide_bitmaps_leave_leader_pairs_that_are_links(spark, make):
    """Half the runs of long lines in common: the narrow bitmap leaves such pairs, whose texts were fetched for nothing."""
    from pyspark.sql import functions as F

    rng = random.Random(41)
    common = " ".join(_words(rng, 58))
    lines = [common + " " + " ".join(_words(rng, 22)) for _ in range(60)]
    lines += [text + "q" for text in lines[:12]]
    texts = linededup.signed_texts(make(list(enumerate(lines)))).select("line", "text")
    pairs = texts.select(F.col("line").alias("u")).crossJoin(texts.select(F.col("line").alias("v"))).where("u < v")
    near = linededup.possible(pairs, linededup.wide_bitmaps(texts), 0.8)
    links = {(r.u, r.v) for r in linededup.similar(near, texts, 0.8).collect()}
    assert links and links == {(r.u, r.v) for r in linededup.similar(pairs, texts, 0.8).collect()}
    assert near.count() < 3 * len(links)
    assert linededup.possible(pairs, linededup.bitmaps(texts), 0.8).count() > 1000


def test_texts_of_a_pair_are_cut_once_each(spark, make):
    """The filter must not be written into the join, where it cut each text three times (F2)."""
    from pyspark.sql import functions as F

    rows = make([(1, "one line of text\none line of text!"), (2, "another line")])
    texts = linededup._lines(rows)
    pairs = texts.select(F.col("line").alias("u")).crossJoin(texts.select(F.col("line").alias("v"))).where("u < v")
    plan = linededup.similar(pairs, texts, 0.8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("array_distinct") == 2 and plan.count("array_intersect") == 1
    assert linededup.similar(pairs, texts, 0.8).count() == 1


def test_texts_that_share_a_bucket_do_not_move(spark, make):
    text = " ".join(_words(random.Random(43), 30))
    signed = linededup.signed_texts(make([(1, text), (2, text + "q"), (3, "other")]))
    met = linededup.members(signed)
    shared = linededup.shared_texts(signed, met)
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
    assert sorted(r.text for r in shared.collect()) == [text, text + "q"]


def test_lines_in_several_buckets_are_paired_once(spark, make):
    """A pair leaves the tiles once however many buckets it shares, and no pair is lost (F2)."""
    from pyspark.sql import functions as F

    rng = random.Random(47)
    lines = [" ".join(_words(rng, 30)) for _ in range(120)]
    lines += [text + "q" for text in lines[:40]]
    rows = make(list(enumerate(lines)))
    roots = spark.createDataFrame([], "node long, root long")
    signed = linededup.settle(linededup.signatures(rows), "signed")
    made = []
    for buckets in ("array(1L)", "array(1L, 2L, 3L + line % 4, 10L + line % 3)"):
        many = linededup.settle(signed.withColumn("buckets", F.expr(buckets)), "signed")
        met = linededup.members(many)
        led = linededup.leaders(met)
        out = linededup.other_pairs(met, led, roots, many, 0.8)
        assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
        made.append([(r.u, r.v) for r in out.collect()])
    assert len(made[0]) == len(set(made[0])) >= 20 and len(made[1]) == len(set(made[1]))
    assert set(made[0]) <= set(made[1])


def test_main_path_is_native(spark, folder):
    plan = queries.QUERIES["op10_line_dedup"](spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
