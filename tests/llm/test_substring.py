from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa

from cases import awkward, clashing, empty
from statewatt.llm import substring

DOCS = "doc_id long, text string"


def sentence(rng, n):
    return " ".join(f"t{rng.randrange(5000)}" for _ in range(n)) + rng.choice([".", "!", "?"])


def table():
    rng = random.Random(4)
    shared = [" ".join(sentence(rng, 14) for _ in range(4)) for _ in range(3)]
    rows = []
    for i in range(60):
        parts = [sentence(rng, rng.randrange(4, 20)) for _ in range(rng.randrange(3, 9))]
        if i % 3 == 0:
            parts.insert(rng.randrange(len(parts)), shared[i % 2].upper() if i % 4 else shared[i % 2])
        if i % 5 == 0:
            parts.append("All rights reserved.")
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    rows += [(70, rows[5][1]), (71, None), (72, ""), (73, " \n. ! ?"), (None, rows[9][1]), (74, shared[2] + "\n" + shared[2]), (75, rows[7][1]), (75, rows[7][1])]
    return rows


def brute(rows, min_words=25):
    rows = sorted({(i is None, i, t or "") for i, t in rows}, key=lambda r: (r[0], r[1] or 0, r[2]))
    seen, out = {}, set()
    for _, i, text in rows:
        run = []

        def close():
            if run and sum(w for _, _, w, _ in run) >= min_words:
                kept = sorted({k for *_, k in run}, key=lambda k: (k is None, k))
                out.add((i, run[0][0], run[-1][1], sum(w for _, _, w, _ in run), kept[0], tuple(kept)))
            run.clear()

        at = 0
        for piece in re.split(r"(?<=[.!?])(?=\s)|(?=\n)", text):
            words = re.findall(r"\w+", piece.lower())
            if piece.strip():
                start = at + len(piece) - len(piece.lstrip())
                key = " ".join(words) or piece.strip()
                if key in seen:
                    run.append((start, at + len(piece), len(words), seen[key]))
                else:
                    seen[key] = i
                    close()
            at += len(piece)
        close()
    return out


def plain(rows):
    return {(r["doc_id"], r["start"], r["end"], r["words"], r["kept_doc_id"], tuple(sorted(r["kept_doc_ids"]))) for r in rows}


def test_is_brute_force(spark):
    docs = spark.createDataFrame(table(), DOCS).repartition(6)
    found = plain(substring.repeated_passages(docs).collect())
    assert found == brute(table()) and len(found) > 20
    assert 74 in {f[0] for f in found}


def test_offsets_cut_the_original(spark):
    rows = [r for r in table() if r[0] is not None and r[0] != 75]
    docs = spark.createDataFrame(rows, DOCS)
    found = substring.repeated_passages(docs)
    cut = {r["doc_id"]: r["text"] for r in substring.without_passages(docs, found).collect()}
    spans = defaultdict(list)
    for r in found.collect():
        spans[r["doc_id"]].append((r["start"], r["end"]))
    for i, text in rows:
        want = text
        for a, b in sorted(spans[i], reverse=True):
            want = want[:a] + want[b:]
        assert cut[i] == want


def test_awkward_rows(spark):
    found = substring.repeated_passages(clashing(awkward(spark))).collect()
    assert {(r["doc_id"], r["kept_doc_id"]) for r in found} >= {(2, 1), (3, 1), (None, 7), (11, 10)}
    assert not {4, 5, 6, 12, 13, 14} & {r["doc_id"] for r in found}


def test_empty_table(spark):
    assert substring.repeated_passages(empty(spark)).count() == 0


def words_left(rows, found):
    """For each (doc, text) the words, and whether each is wholly inside a removed run."""
    spans = defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append((r["start"], r["end"]))
    for i, text in rows:
        marks = [(m.group().lower(), any(a <= m.start() and m.end() <= b for a, b in spans[i])) for m in re.finditer(r"\S+", text)]
        yield i, [w for w, _ in marks], [g for _, g in marks]


def spliced():
    """Passages of 50 to 100 words in the middle of sentences, none with a unit
    that would do by itself, beside ones of 49 words; a text that repeats itself."""
    rng = random.Random(9)
    rows, want = [], {}
    for n, size in enumerate([49, 50, 51, 64, 77, 99, 100] * 3):
        gap = (4, 9, 200)[n // 7]  # words between full stops: short units, middling ones, none
        passage = [f"p{n}x{k}" + ("." if k % gap == gap - 1 else "") for k in range(size)]
        for copy in range(3):
            around = [[f"a{n}c{copy}s{side}w{k}" for k in range(rng.randrange(3, 40))] for side in (0, 1)]
            own = [w.upper() for w in passage] if copy == 1 else passage
            rows.append((10 * n + copy, rng.choice([" ", "\n"]).join(around[0] + own + around[1])))
            want[10 * n + copy] = (len(around[0]), len(around[0]) + size) if copy and size >= 50 else None
    rows.append((900, "Ja " * 400))
    want[900] = (50, 400)
    return rows, want


def test_passages_spliced_into_sentences(spark):
    rows, want = spliced()
    found = substring.repeated_passages(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    for i, words, gone in words_left(rows, found):
        a, b = want[i] or (0, 0)
        if i // 10 % 7 == 0 and i < 900 and i // 70 < 2:
            continue  # 49 words: whole units of these may go, by their own rule
        assert gone == [a <= k < b for k in range(len(words))], i
    by_doc = {r["doc_id"]: r for r in found}
    assert by_doc[12]["kept_doc_ids"] == [10] and by_doc[12]["words"] == 50


def test_no_shared_stretch_is_left(spark):
    rng = random.Random(12)
    source = [f"s{rng.randrange(300)}" + rng.choice(["", "", "", "", ".", ","]) for _ in range(4000)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(3900)
            words += source[at : at + rng.randrange(20, 120)]
            words += [f"o{rng.randrange(10**6)}" for _ in range(rng.randrange(12))]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    found = substring.repeated_passages(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    seen, hits = {}, 0
    for i, words, gone in words_left(rows, found):
        for k in range(len(words) - 49):
            gram = tuple(words[k : k + 50])
            if gram in seen:
                doc, at = seen[gram]
                hits += 1
                assert all(gone[max(k, at + 50) if doc == i else k : k + 50]), (i, k)
            else:
                seen[gram] = (i, k)
    assert hits > 1000


def test_what_stands_once_stays(spark):
    """Short units inside a repeated run: words that differ stay, all of them."""
    rng = random.Random(21)
    rows, own = [], {}
    for i in range(120):
        a, b = (" ".join(f"r{i // 3}x{k}y{j}" for k in range(20)) + "." for j in range(2))
        middle = rng.choice(["Yes.", "No!", "Well?", "***", "Ja ja.", f"Only {i}."])
        rows.append((i, rng.choice([" ", "\n", "\n\n"]).join([a, middle, b])))
        own[i] = middle
    found = substring.repeated_passages(spark.createDataFrame(rows, DOCS).repartition(5)).collect()
    spans = defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append((r["start"], r["end"]))
    seen = {}
    for i, text in rows:
        at = text.index(own[i])
        gone = any(a <= at < b for a, b in spans[i])
        assert not gone or own[i] in seen, (i, own[i])
        seen.setdefault(own[i], i)


def test_scripts_without_spaces(spark):
    passage = "".join(chr(0x4E00 + k * 7 % 5000) + ("\u3002" if k % 15 == 14 else "") for k in range(60))
    rows = [(1, "\u7532\u3002" + passage + "\u4e59\u3002"), (2, "\u4e19\u3002" + passage + "\u4e01\u3002")]
    found = substring.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r["doc_id"], r["start"], r["end"], r["words"]) for r in found] == [(2, 2, 66, 60)]


def test_texts_cut_together_are_cut_as_by_the_rule():
    rng = random.Random(31)
    parts = ["a", "b1", "\u03a3", "\u0130x", "_", "\u4e00", "\u0e01", ".", "!", "?!", "\u3002", "\uff01\uff1f", " ", "  ", "\n", "\x1c", "\u2003", "\u0307", "-", "\U0001f600"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    texts += [" ".join(f"w{rng.randrange(3)}" for _ in range(rng.randrange(40, 200))) for _ in range(30)] + [" ", "\n", "x" * 5000]
    rule = re.compile(r"[^\n]*?(?:[.!?]+(?=\s)|[\u3002\uff01\uff1f]+|(?=\n)|\Z)", re.S)
    want = []
    for i, text in enumerate(texts):
        at, n, low = 0, 0, text.replace("\u0130", "i").lower()
        while at < len(text):
            end = max(rule.match(text, at).end(), at + 1)
            if solid := low[at:end].lstrip():
                words = substring._WORD.findall(solid)
                own = " ".join(words) if words else "\0" + solid.rstrip()
                before = [] if len(words) >= 3 else [w for w in want[-2:] if w[0] == i][-1:]
                if before and before[0][4] < 3:
                    before = [w for w in want[-2:] if w[0] == i]
                want.append((i, n, end - len(solid), end, len(words), "\1".join([w[6] for w in before] + [own]), own))
                n += 1
            at = end
    whole = None
    for limit in (1, 300, 1 << 18):
        got, hashes, segments = [], [], []
        for places, cut in substring._chunks(pa.array(["", *texts, None]), limit):
            for part, into in ((cut.unit, got), (cut.segment, segments)):
                for text, row in zip(part[0].tolist(), cut.rows(part).T.tolist()):
                    into.append((places[text] - 1, row[0], row[1], row[2], row[4] - row[3]))
            hashes += [(h, cut.digest(k)) for k, h in enumerate(cut.unit_hashes.tolist())]
            segments += cut.hashes[cut.unit.shape[1] :].tolist()
        assert got == [w[:5] for w in want]
        # equal words, equal hashes and digests, and only those
        assert len({w[5] for w in want}) == len(set(hashes)) == len(set(zip(hashes, (w[5] for w in want)))) == len({h for h, _ in hashes})
        whole = whole or sorted(map(str, segments))
        assert sorted(map(str, segments)) == whole and len(whole) > 30


def test_a_window_lies_in_one_text():
    cut = substring._Texts(["a " * 49, "b " * 50, "c " * 30, "d " * 21 + "e " * 40])
    assert set(cut.segment[0].tolist()) == {1, 3} and len(cut.window) == 13
    assert np.all(np.diff(cut.starts) > 0)


def test_short_units_are_told_by_what_stands_before(spark):
    rng = random.Random(41)
    words = [f"c{k}" for k in range(40)]
    lists = [(i, "\n".join(rng.choice(words) for _ in range(120))) for i in range(20)]
    tale = [" ".join(f"s{k}x{j}" for j in range(12)) + "." for k in range(3)]
    rows = lists + [(50, " ".join([tale[0], "Yes.", tale[1], "So.", "Ja!", tale[2]])), (51, " ".join(["Own.", tale[0], "Yes.", tale[1], "So.", "Ja!", tale[2]])), (52, " ".join([tale[0], "Yes.", tale[1], "So.", "No!", tale[2]]))]
    found = {(r["doc_id"], r["start"], r["end"], r["words"]) for r in substring.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == {(51, 5, len(rows[-2][1]), 39), (52, 0, rows[-1][1].index(" No!"), 26)}


def test_blocks_do_not_decide_what_goes(spark):
    """Long runs that texts share in part, also within one text: as the plain rule has it."""
    rng = random.Random(51)
    tale = [" ".join(f"u{k}v{j}" for j in range(rng.randrange(3, 7))) + rng.choice([".", "!"]) for k in range(300)]
    same = "All of it again."
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            at = rng.randrange(300)
            parts += tale[at : at + rng.randrange(2, 150)] + [" ".join(f"o{i}x{len(parts)}y{j}" for j in range(4)) + "."] * rng.randrange(2)
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    rows += [(60, " ".join([same] * 200)), (61, " ".join([same] * 70)), (62, rows[7][1]), (62, rows[7][1]), (None, rows[8][1]), (63, " ".join(tale + tale))]
    found = plain(substring.repeated_passages(spark.createDataFrame(rows, DOCS).repartition(5)).collect())
    want = brute(rows)
    assert {f[:5] for f in found} == {w[:5] for w in want} and len(want) > 60
    kept = {f[:3]: set(f[5]) for f in found}
    assert all(set(w[5]) - {None} <= kept[w[:3]] for w in want)
    cut = substring._Texts([" ".join(tale), " ".join([same] * 200)])
    a, b = cut.blocks(np.arange(500))
    assert 20 < len(a) < 100 and int((b - a).max()) <= substring.BLOCK and 300 in a.tolist()
    assert a.tolist()[1:] == b.tolist()[:-1] and b[-1] == 500
