"""Near and repeated texts against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestep.llm import components, paragraphs, simhash, suffix
from lodestep.llm.common import read


def connected(n, links):
    label = list(range(n))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_few_links_are_stored_by_few_tasks(spark, monkeypatch):
    """Also where no coalescing by adaptive execution helps: rounds over a handful of links cost a handful of tasks."""
    files, store = [], components.stored

    def counted(df, label):
        out = store(df, label)
        files.append((label, len(out.inputFiles())))
        return out

    monkeypatch.setattr(components, "stored", counted)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = components.components(spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long"))
        assert {r["component"] for r in got.collect()} == {0} and got.count() == 301
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(n for label, n in files if label != "links") <= spark.sparkContext.defaultParallelism


def test_components_of_chains_stars_and_nothing(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(7, 7), (900, 3), (3, 900), (2, 1)]
    links += [tuple(map(int, x)) for x in rng.integers(1000, 1400, (150, 2))]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    roots = connected(1400, links)
    assert got == {n: roots[n] for l in links if l[0] != l[1] for n in l}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_prints(rows):
    import xxhash

    out = []
    for text in rows:
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 3 else [b" ".join(words)] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        out.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return out


@pytest.mark.parametrize("split", [simhash.SPLIT_ABOVE, 2])
def test_simhash_components(docs, edges, nothing, split, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT_ABOVE", split)
    for table in (docs, edges):
        rows = table.select("doc_id", "text").collect()
        prints = brute_prints(r["text"] for r in rows)
        links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
        groups = defaultdict(list)
        for r, c in zip(rows, connected(len(rows), links)):
            groups[c].append(r["doc_id"])
        least = {c: min((i for i in g if i is not None), default=None) for c, g in groups.items()}
        want = Counter((r["doc_id"], f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, connected(len(rows), links)))
        assert Counter(map(tuple, simhash.near_duplicates(table).collect())) == want
    assert simhash.near_duplicates(nothing).count() == 0


def test_simhash_links_of_crowded_halves():
    """Fingerprints that share halves up to a bit, so that keys crowd; every pair within three bits must be connected."""
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    prints = []
    for b in base:
        for _ in range(60):
            x = int(b)
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(bit)
            prints.append(x)
    prints = np.unique(np.array(prints, np.uint64))
    forest = simhash._forest(prints, prints, 3)
    at = {int(p): i for i, p in enumerate(prints)}
    whole = [(i, j) for i in range(len(prints)) for j in range(i) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 3]
    assert connected(len(prints), [(at[int(a)], at[int(b)]) for a, b in forest]) == connected(len(prints), whole)
    assert len(forest) < len(prints)


@pytest.mark.parametrize("split", [simhash.SPLIT_ABOVE, 5])
def test_simhash_links_in_spark(spark, split, monkeypatch):
    monkeypatch.setattr(simhash, "SPLIT_ABOVE", split)
    rng = np.random.default_rng(3)
    prints = set()
    for b in rng.integers(0, 1 << 63, 6, dtype=np.uint64):
        for _ in range(80):
            x = int(b)
            for bit in rng.choice(64, rng.integers(0, 5), replace=False):
                x ^= 1 << int(bit)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    at = {p: i for i, p in enumerate(signed)}
    whole = [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    assert connected(len(prints), [(at[r["u"]], at[r["v"]]) for r in got]) == connected(len(prints), whole)


def brute_removed(rows, length):
    seen = Counter()
    raws = [(t or "").encode() for t in rows]
    for raw in raws:
        seen.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        mark = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        kept = bytes(c for c, m in zip(raw, mark) if not m)
        runs = sum(m and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark))
        out.append((len(raw), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bucket", [suffix.BUCKET, 2])
def test_repeated_bytes(docs, edges, nothing, bucket, monkeypatch):
    monkeypatch.setattr(suffix, "BUCKET", bucket)
    for table in (docs.filter("doc_id < 90"), edges):
        rows = table.select("doc_id", "text").collect()
        want = Counter((r["doc_id"], *x) for r, x in zip(rows, brute_removed([r["text"] for r in rows], suffix.LENGTH)))
        got = Counter(map(tuple, suffix.remove_repeats(table).drop("kept").collect()))
        assert got == want
    assert suffix.remove_repeats(nothing).count() == 0


def test_starts_of_repeats_around_anchors():
    rng = np.random.default_rng(0)
    reach, length = suffix.LENGTH - suffix.GRAM, suffix.LENGTH
    number, low, high, left, content = [], [], [], [], []
    for bucket in range(60):
        base = rng.integers(97, 123, reach + length, dtype=np.uint8)
        first, last = [(0, reach), (30, 100), (90, reach), (68, 68)][bucket % 4]
        for _ in range(int(rng.integers(1, 12))):
            row = base.copy()
            for at in rng.integers(0, reach + length, int(rng.integers(0, 3))):
                if not reach <= at < length:
                    row[at] = 64
            begin, end = (0, reach + length) if rng.random() < 0.7 else (int(rng.integers(0, reach + 1)), int(rng.integers(length, reach + length + 1)))
            for to, value in zip((number, low, high, left, content), (bucket, first, last, reach - begin, row[begin:end].tobytes())):
                to.append(value)
    strings = defaultdict(list)
    for i, raw in enumerate(content):
        for s in range(low[i], high[i] + 1):
            if s <= left[i] and left[i] - s + length <= len(raw):
                strings[number[i], s, raw[left[i] - s:left[i] - s + length]].append(i)
    want = defaultdict(list)
    for (_, s, _), rows in strings.items():
        for i in rows if len(rows) > 1 else []:
            want[i].append(s)
    before, after = suffix._starts(np.array(number, np.uint64), np.array(low), np.array(high), np.array(left), content)
    assert before.tolist() == [max(want.get(i, [-1])) for i in range(len(content))]
    assert after.tolist() == [length - min(want[i]) if i in want else -1 for i in range(len(content))]
    assert (before >= 0).any() and (before < 0).any()


def test_repeated_bytes_within_pieces_and_periods(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 700)
    rng = np.random.default_rng(5)
    noise = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = [noise(n) for n in (199, 200, 201, 350)]
    rows = [(i, noise(int(rng.integers(0, 900))) + shared[i % 4] + noise(int(rng.integers(0, 300))) + shared[(i + 1) % 4]) for i in range(24)]
    rows += [(100, "ab" * 600), (101, "ab" * 150 + noise(50)), (102, "=" * 199), (103, "=" * 200 + noise(30)), (104, "z" * 201)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter((i, *x) for (i, _), x in zip(rows, brute_removed([t for _, t in rows], 200)))
    assert Counter(map(tuple, suffix.remove_repeats(table).drop("kept").collect())) == want


def plain_words(text):
    """(word, start, end in bytes) with A-Z in lower case."""
    raw = (text or "").encode()
    return [(m[0].lower(), m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]


def brute_paragraphs(rows, similarity=0.8, least=paragraphs.MIN_WORDS):
    """Plain form: chunks as tuples of words, stretches of chunks that occur again, all pairs. Rows are (doc_id, text).

    Returns (row, first chunk, start, end, words, has a first occurrence) and the groups of their numbers.
    """
    chunks = []
    for r, (_, text) in enumerate(rows):
        words = plain_words(text)
        edge = paragraphs.cuts(paragraphs.tokens((text or "").encode())[0]) if words else []
        chunks.append([(tuple(w for w, _, _ in words[a:b]), words[a][1], words[b - 1][2]) for a, b in zip(edge, edge[1:])])
    where = defaultdict(list)
    for r, mine in enumerate(chunks):
        for k, (content, _, _) in enumerate(mine):
            where[content].append((r, k))
    found = []
    for r, mine in enumerate(chunks):
        island = []
        for k in [k for k, (content, _, _) in enumerate(mine) if len(where[content]) > 1] + [None]:
            if island and (k is None or k - island[-1] > 2):
                size = sum(len(mine[i][0]) for i in island)
                if size >= least:
                    found.append((r, island[0], mine[island[0]][1], mine[island[-1]][2], size, [mine[i][0] for i in island]))
                island = []
            island.append(k)
    sets = []
    for r, _, start, end, _, _ in found:
        words = [w for w, a, b in plain_words(rows[r][1]) if start <= a and b <= end]
        sets.append(frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))))
    links = [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]) - 1e-9]
    groups = defaultdict(list)
    for i, g in enumerate(connected(len(sets), links)):
        groups[g].append(i)
    return found, list(groups.values())


def checked_paragraphs(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    found, groups = brute_paragraphs(rows)
    told = lambda i: (rows[found[i][0]][0] is None, rows[found[i][0]][0] or 0, *found[i][1:5])
    want = Counter(tuple(sorted(told(i) for i in g)) for g in groups)
    got = defaultdict(list)
    for r in paragraphs.repeated(df).collect():
        got[r["component_id"]].append(r)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["paragraph"], r["start"], r["end"], r["words"])
    assert Counter(tuple(sorted(map(key, g))) for g in got.values()) == want
    for g in got.values():
        assert all(r["members"] == len(g) for r in g)
        if len(g) > 1:
            kept = [r for r in g if not r["removed"]]
            assert len(kept) == 1 and key(kept[0])[:3] == min(map(key, g))[:3]
            assert all((r["keep_doc_id"], r["keep_paragraph"]) == (kept[0]["doc_id"], kept[0]["paragraph"]) for r in g)
    return rows, [r for g in got.values() for r in g]


def test_paragraphs_equal_the_plain_form(docs, edges, nothing):
    rows, found = checked_paragraphs(docs)
    assert found
    checked_paragraphs(edges)
    checked_paragraphs(edges.unionByName(edges))
    assert paragraphs.repeated(nothing).count() == 0 and paragraphs.repeated(edges.filter("text IS NULL")).count() == 0


def test_passages_are_found_and_clean_texts_left_alone(docs):
    """Runs of 50 words that stand in other texts too, against rows of the operator; texts that share no nine words have no row."""
    rows = [(r["doc_id"], [w for w, _, _ in plain_words(r["text"])]) for r in docs.select("doc_id", "text").collect()]

    def shared(width):
        holders = defaultdict(set)
        for doc, words in rows:
            for i in range(len(words) - width + 1):
                holders[tuple(words[i:i + width])].add(doc)
        return {doc for held in holders.values() if len(held) > 1 for doc in held}

    long, any_at_all = shared(50), shared(9)
    got = {r["doc_id"] for r in paragraphs.repeated(docs).select("doc_id").distinct().collect()}
    assert len(got & long) >= 0.95 * len(long)
    inside = {doc for doc, words in rows if len(words) > len({tuple(words[i:i + 9]) for i in range(len(words) - 8)}) + 8}
    assert not got - any_at_all - inside


def test_words_and_their_places(monkeypatch):
    rng = np.random.default_rng(2)
    texts = [" ", "a", "\tTwo  words\x0b", "naïve ÄÖ " * 30, "x" * 500 + " y", "".join(rng.choice(list("abC \n\t"), 3000))]
    for stretch in (paragraphs.STRETCH, 64, 1):
        monkeypatch.setattr(paragraphs, "STRETCH", stretch)
        names = {}
        for text in texts:
            value, start, end = paragraphs.tokens(text.encode())
            assert list(zip(start, end)) == [(a, b) for _, a, b in plain_words(text)]
            for v, (w, _, _) in zip(value.tolist(), plain_words(text)):
                assert names.setdefault(w, v) == v
        assert len(set(names.values())) == len(names)
    assert all(len(x) == 0 for x in paragraphs.tokens(b""))


def test_banding_reaches_its_recall():
    bands, rows = paragraphs.tune(0.8)
    assert 1 - (1 - 0.8**rows) ** bands >= paragraphs.RECALL and bands * rows <= paragraphs.MOST_HASHES
    with pytest.raises(ValueError):
        paragraphs.tune(0.01, 0.9999, 4)


@pytest.mark.parametrize("block", [paragraphs.BLOCK, 20])
def test_near_paragraphs_of_a_large_family(spark, block, monkeypatch):
    """Many edits of one paragraph: leaders connect most, the rest is found by verifying what is still apart."""
    monkeypatch.setattr(paragraphs, "BLOCK", block)
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]
    base = [words[i] for i in rng.integers(0, 400, 120)]
    rows = []
    for i in range(150):
        copy = list(base)
        for at in rng.choice(120, rng.integers(0, 7), replace=False):
            copy[at] = words[rng.integers(0, 400)]
        rows.append((i, " ".join(copy)))
    _, found = checked_paragraphs(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert max(r["members"] for r in found) > 50


def test_passages_in_mid_line_wrapped_and_short_lines(spark):
    rng = np.random.default_rng(4)
    passage = [f"w{i}" for i in rng.integers(0, 500, 80)]
    other = [" ".join(f"v{k}{i}" for i in rng.integers(0, 500, 60)) for k in range(4)]
    wrap = lambda n: "\n".join(" ".join(passage[i:i + n]) for i in range(0, 80, n))
    short = "one two three four five six seven eight nine"
    rows = [(1, f"{other[0]} {' '.join(passage)} {other[0][::-1]}\n{short}"), (2, f"{wrap(13)}\n\n{other[1]}\n{short}"),
            (3, f"{short}\n{other[2]} {wrap(7).upper()}"), (4, f"{short}\n{other[3]}")]
    _, found = checked_paragraphs(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in found) == [1, 2, 3]  # the short line alone is no paragraph
    texts = {i: t.encode() for i, t in rows}
    for r in found:
        assert texts[r["doc_id"]][r["start"]:r["end"]].lower().split()[5:-5] == [w.encode() for w in passage][
            passage.index(texts[r["doc_id"]][r["start"]:r["end"]].lower().split()[0].decode()):][5:r["words"] - 5]
    assert [r["removed"] for r in sorted(found, key=lambda r: r["doc_id"])] == [False, True, True]


def plain_units(text, least):
    """(start, end, words) of lines, blocks between blank lines and the whole text, in bytes."""
    words = plain_words(text)
    raw = (text or "").encode()
    breaks = [raw[a:b].count(b"\n") for (_, _, a), (_, b, _) in zip(words, words[1:])]
    out = set()
    for lines in (1, 2, len(raw) + 1):
        begin = 0
        for i in range(1, len(words) + 1):
            if i == len(words) or breaks[i - 1] >= lines:
                if i - begin >= least:
                    out.add((words[begin][1], words[i - 1][2], tuple(w for w, _, _ in words[begin:i])))
                begin = i
    return out


def checked_near(df, least=paragraphs.MIN_WORDS):
    """All similar pairs of lines, blocks and texts that do not overlap are in one component; what is added to the repeated chunks is in such a pair."""
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    units = [(i, a, b, words) for i, (_, text) in enumerate(rows) for a, b, words in plain_units(text, least)]
    sets = [frozenset(tuple(u[3][i:i + 5]) for i in range(max(1, len(u[3]) - 4))) for u in units]
    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    pairs = {(min(i, j), max(i, j)) for held in holders.values() for i in held for j in held if i != j}
    apart = [(i, j) for i, j in pairs if units[i][0] != units[j][0] or units[i][1] >= units[j][2] or units[j][1] >= units[i][2]]
    alike = [(i, j) for i, j in apart if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    found = [r.asDict() for r in paragraphs.near_duplicates(df).collect()]
    where = defaultdict(list)
    for r in found:
        where[r["doc_id"]].append(r)
    over = [{r["component_id"] for r in where[rows[i][0]] if r["start"] < b and a < r["end"]} for i, a, b, _ in units]
    assert all(over[i] & over[j] for i, j in alike)
    key = lambda r: (r["doc_id"], r["paragraph"], r["start"], r["end"], r["words"])
    before = Counter(map(key, (r.asDict() for r in paragraphs.repeated(df).collect())))
    assert not before - Counter(map(key, found))
    similar = {(rows[units[i][0]][0], *units[i][1:3]) for pair in alike for i in pair}
    assert all(key(r) in before or (r["doc_id"], r["start"], r["end"]) in similar for r in found)
    groups = defaultdict(list)
    for r in found:
        groups[r["component_id"]].append(r)
    for g in groups.values():
        assert all(r["members"] == len(g) for r in g) and (len(g) == 1 or sum(not r["removed"] for r in g) == 1)
    return alike, found


def test_near_copies_without_common_chunks(spark, docs, edges, nothing):
    """Lines, blocks and texts with a few changed words are found though too few of their chunks recur."""
    rng = np.random.default_rng(17)
    prose = lambda name, n: [f"{name}{i}" for i in rng.integers(0, 900, n)]
    rows, lost = [], 0
    for k in range(60):
        a = prose(f"k{k}x", 60)
        b = list(a)
        b[30] = "changed"
        kind = k % 3
        if kind == 0:  # whole texts
            rows += [(2 * k, " ".join(a)), (2 * k + 1, "\n".join([" ".join(b[:33]), " ".join(b[33:])]))]
        elif kind == 1:  # lines
            rows += [(2 * k, " ".join(prose("o", 70)) + "\n" + " ".join(a)), (2 * k + 1, " ".join(b).upper() + "\n" + " ".join(prose("p", 30)))]
        else:  # two lines of one text
            rows.append((2 * k, "\n".join([" ".join(a), " ".join(prose("q", 25)), " ".join(b)])))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    alike, found = checked_near(table)
    assert {r["doc_id"] for r in found if r["members"] > 1} == {i for i, _ in rows} and len(alike) >= 60
    assert len({r["doc_id"] for r in paragraphs.repeated(table).filter("members > 1").collect()}) < len(rows) / 2
    alike, found = checked_near(docs)
    assert alike
    checked_near(edges.filter("doc_id NOT IN (4, 11) AND doc_id IS NOT NULL"))
    near = paragraphs.near_duplicates(edges).collect()
    assert {r["doc_id"] for r in near} >= {None, 4, 5, 9} and len([r for r in near if r["doc_id"] == 4]) == 2
    assert paragraphs.near_duplicates(nothing).count() == 0


def test_overlapping_paragraphs_of_a_component():
    def stays(*spots):
        whole, start, end = map(np.array, zip(*spots))
        return sorted(paragraphs.outermost(whole, start, end).tolist())

    assert stays((True, 0, 90), (True, 10, 90)) == [0]  # a line that nearly fills its text
    assert stays((True, 0, 100), (True, 0, 50), (True, 50, 100)) == [1, 2]  # a repetition inside a text
    assert stays((True, 0, 90), (False, 5, 80), (True, 100, 120)) == [1, 2]  # a stretch stays
    assert stays((True, 0, 99), (True, 0, 40), (True, 2, 40), (True, 50, 99)) == [1, 3]
    assert stays((False, 0, 10), (False, 20, 30)) == [0, 1]


def test_chunks_are_told_apart_by_one_number(edges):
    """row + number is a number of its own for each chunk of a partition, in the order of texts."""
    rows = paragraphs._chunks(edges.coalesce(1), "doc_id", "text", 20).filter("NOT whole").select("row", "number").collect()
    at = [r["row"] + r["number"] for r in rows]
    assert at == list(range(len(rows))) and len(rows) > 100


def test_equal_texts_are_signed_once(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(i, text) for i in (3, 4, 5, None)], "doc_id long, text string")
    stretches = paragraphs._stretches(paragraphs._chunks(docs, "doc_id", "text"), 20)
    assert stretches.count() == 4
    signed = paragraphs._signed(docs, stretches, "doc_id", "text", 18, 5)
    assert signed.count() == 1
    assert paragraphs.near_duplicates(docs).agg({"members": "min", "keep_doc_id": "max"}).first()[:] == (4, 3)


def test_a_leader_is_not_verified_twice(spark, monkeypatch):
    """Under a key of two paragraphs nothing is left to verify; under one of three, two are, and their link is found."""
    seen, plain = [], paragraphs._still_apart
    monkeypatch.setattr(paragraphs, "_still_apart", lambda rows, found: seen.append(rows.count()) or plain(rows, found))
    a, b, c = list(range(100)), list(range(1000, 1100)), list(range(1000, 1095))
    shape = "id long, n long, bands array<long>, first_mark long, last_mark long, last_start long, first_end long, shingles array<long>"

    def linked(*sets):
        rows = spark.createDataFrame([(i, len(x), [7], i, i, 0, 9, x) for i, x in enumerate(sets)], shape)
        return {(r["u"], r["v"]) for r in paragraphs.links(rows.drop("shingles"), rows.select("id", "shingles"), 0.8).collect()}

    assert linked(a, b) == set() and seen == [1]
    for sets, link in (((a, b, c), (1, 2)), ((b, a, c), (0, 2)), ((b, c, a), (0, 1))):  # whichever leads
        assert {tuple(sorted(x)) for x in linked(*sets)} == {link}
