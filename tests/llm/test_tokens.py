import os
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import docs, empty, rows_of, texts
from fieldmart.llm import token_counts, token_files

PIECE, WORD = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def test_counts_are_those_of_the_library(spark):
    sp = token_counts.load(PIECE)
    expected = [(r.doc_id, len((r.text or "").encode()), n := len(sp.encode(r.text or "")), n > 50) for r in docs(spark).collect()]
    assert rows_of(token_counts.token_counts(docs(spark), PIECE, limit=50), "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)
    assert token_counts.token_counts(empty(spark), PIECE).count() == 0


def test_whole_tokens_are_proved():
    proof, sp = token_counts.prove(PIECE), token_counts.load(PIECE)
    assert len(proof.whole) > 10_000
    assert all(len(sp.encode(w[1:].replace("▁", " "))) == 1 for w in sorted(proof.whole)[::97])


def test_files_are_read_back(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD)
    path = str(tmp_path / "ids")
    token_files.write_token_files(docs(spark), path, WORD)
    found = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in docs(spark).collect()), key=lambda i: (i is not None, i))
    at = 0
    for r in found:
        assert r.start == at
        at += r.n_tokens
    ids = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    expected = sorted(((r.doc_id, len(x), zlib.crc32(x.tobytes())) for r in docs(spark).collect() for x in [ids(r.text)]), key=repr)
    assert rows_of(spark.createDataFrame(found), "doc_id", "n_tokens", "ids_crc32") == expected


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(empty(spark), path, WORD)
    assert token_files.read_token_files(spark, path).count() == 0


def test_blocks_round_trip():
    rng = np.random.default_rng(4)
    for top in (0, 1, 5, 300, 49_407):
        blocks = [rng.integers(0, top, rng.integers(1, 700), endpoint=True) for _ in range(30)] + [np.tile(rng.integers(0, top, 3, endpoint=True), 400)]
        packed = token_files.Table.of(np.concatenate(blocks), 49_407).pack()
        table = token_files.Table.unpack(packed, 49_407)
        coded = token_files.encode_blocks(blocks, table)
        assert all((a == b).all() for a, b in zip(blocks, token_files.decode_blocks(coded, table), strict=True))
        assert (token_files.decode_blocks(coded[5:6], token_files.Table.unpack(packed, 49_407))[0] == blocks[5]).all()  # a block can be read alone
    assert len(coded[-1]) < len(blocks[-1])  # repeated contexts are predicted


def test_broken_blocks_are_found():
    ids = np.arange(100)
    table = token_files.Table.of(ids, 49_407)
    block = bytearray(token_files.encode_blocks([ids], table)[0])
    block[30] ^= 4
    with pytest.raises(ValueError):
        token_files.decode_blocks([bytes(block)], table)


def test_files_are_smaller_than_deflated_ids(spark, tmp_path):
    """On the benchmark texts: under zlib of the same blocks, and within half a bit of the entropy of single ids."""
    folder, path = "/root/testdata/sf0.01", str(tmp_path / "ids")
    token_files.write_token_files(spark.read.parquet(f"{folder}/documents.parquet").coalesce(1), path, WORD)
    rows = spark.read.parquet(path).collect()
    coded = sum(len(r.table) + sum(map(len, r.blocks)) for r in rows)
    ids = np.concatenate([x for r in rows for x in token_files.decode_blocks(r.blocks, token_files.Table.unpack(r.table, r.largest))])
    counts = np.bincount(ids)
    shares = counts[counts > 0] / len(ids)
    deflated = sum(len(zlib.compress(ids[i: i + token_files.BLOCK].astype("<u2").tobytes(), 9)) for i in range(0, len(ids), token_files.BLOCK))
    entropy = float(-(shares * np.log2(shares)).sum())
    print(8 * coded / len(ids), 8 * deflated / len(ids), entropy)
    assert coded < deflated and 8 * coded / len(ids) < entropy + 0.5


def test_segments_and_memories_are_cut(spark, tmp_path, monkeypatch):
    """Documents longer than a segment, many segments and parts, and a memory of units that is emptied all the time."""
    from tokenizers import Tokenizer

    rng = np.random.default_rng(5)
    long = " ".join(f"w{k}" for k in rng.integers(0, 3000, 60_000))
    rows = [(1, "short one"), (2, long), (3, None), (None, "a"), (None, "b b"), (5, "日本語" * 4000), (5, long[:5000])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    library = Tokenizer.from_file(WORD)
    expected = sorted(((i, len(x), zlib.crc32(x.tobytes())) for i, t in rows for x in [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")]), key=repr)
    for name, value in (("SEGMENT", 5000), ("LANES", 3), ("SLICE", 1000), ("KEPT", 2000)):
        monkeypatch.setattr(token_files, name, value)
    token_files.write_token_files(frame, str(tmp_path / "ids"), WORD)
    found = token_files.read_token_files(spark, str(tmp_path / "ids"))
    assert rows_of(found, "doc_id", "n_tokens", "ids_crc32") == expected
    assert spark.read.parquet(str(tmp_path / "ids")).count() > 2


def test_units_give_the_library_ids():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(WORD), token_files.UnitIds(WORD)
    some = [t or "" for t in texts()] + ["it's I'LL ''s x'sy 1½²ª \x1c\x85'd", "é İ ΑΣ ς"]
    assert [x.tolist() for x in own.texts([t.encode() for t in some], 2)] == [[*library.encode(t, add_special_tokens=False).ids, 2] for t in some]


def test_capitals_whose_small_letters_lie_further_up():
    from tokenizers import Tokenizer

    library, some = Tokenizer.from_file(WORD), ["President Əliyev said", *(f"a{c}b {c}x {c}" for c in "İƁƆƉƊƏƐƓƔƖƗƜƝƟƦƩƮƱƲƷȺȾɄɅ")]
    for t in some:  # each alone, so that each is seen by a fresh one
        assert token_files.UnitIds(WORD).texts([t.encode()], 2)[0].tolist() == [*library.encode(t, add_special_tokens=False).ids, 2]


def test_only_words_that_need_it_go_to_the_whole_library():
    """One foreign or special word does not send its whole text there; of new words some are compared."""
    own = token_files.UnitIds(WORD)
    library, given = own.tokenizer, []

    class Counted:
        def encode(self, text, **settings):
            given.append(text)
            return library.encode(text, **settings)

    own.tokenizer = Counted()
    for extra in ("日本語", "<|endoftext|>ABC", "<|ENDOFTEXT|>", "plain"):
        text = " ".join(f"Wörd{i:x}q's, x{i}" for i in range(6000)) + " " + extra
        own.forget()
        given.clear()
        assert own.texts([b"", text.encode()], 2)[1].tolist() == [*library.encode(text, add_special_tokens=False).ids, 2]
        assert sum(map(len, given)) < len(text) / 2


def test_many_blocks_are_coded_by_the_same_steps(monkeypatch):
    """A step handles an id of every block, and the counts are not made anew for each few ids."""
    steps, counts = [], []
    for name, seen in (("predict", steps), ("recount", counts)):
        run = getattr(token_files._Lanes, name)
        monkeypatch.setattr(token_files._Lanes, name, lambda self, *a, run=run, seen=seen: (seen.append(1), run(self, *a))[1])
    ids = np.random.default_rng(3).integers(0, 3000, (3000, 128))
    table = token_files.Table.of(ids.reshape(-1), 49_407)
    blocks = token_files.encode_blocks(list(ids), table)
    assert len(steps) == 128 and len(counts) <= 3
    assert (np.array(token_files.decode_blocks(blocks, table)) == ids).all()


def test_units_stay_known_between_tasks(spark, tmp_path, monkeypatch):
    """A worker process makes one encoder for all its tasks of a run."""
    made = tmp_path / "made"
    made.mkdir()

    class Noted(token_files.UnitIds):
        def __init__(self, path):
            super().__init__(path)
            with open(made / str(os.getpid()), "a") as f:
                f.write("1")

    monkeypatch.setattr(token_files, "UnitIds", Noted)
    settings = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        frame = spark.range(500).selectExpr("id AS doc_id", "concat('word', id, ' and more') AS text")
        token_files.write_token_files(frame, str(tmp_path / "ids"), WORD)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    times = [f.read_text() for f in made.iterdir()]
    assert spark.read.parquet(str(tmp_path / "ids")).count() > len(times) and set(times) == {"1"}


def test_remembered_units_take_little_memory():
    """As flat arrays, without an object for each word, and none of a text's ids stay."""
    text = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}{chr(97 + i // 17_576)}" for i in range(60_000)).encode()
    own = token_files.UnitIds(WORD)
    own.texts([b"one"], 2)
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        own.texts([text], 2)
        held = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert held < 40 * 60_000
