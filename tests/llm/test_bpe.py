import hashlib
import random
import re

from tidemark.llm import bpe

PIECES = ["a", "b", "th", "ing", "er", " ", "  ", "\n", "'s", "'", "'ll", "!", "!!", "1", "23", "é", "É", "<|endoftext|>", "你好", "é", "́", "İ", "\xa0", "\x1c", "-", "<|", "👍🏽", "ß"]


def random_texts(n, seed=1):
    rng = random.Random(seed)
    for trial in range(n):
        words = rng.choices(PIECES, k=rng.randint(0, 200), weights=[rng.choice([1, 1, 10]) for _ in PIECES])
        if trial % 3 == 0:
            words = [w for w in words if w.strip() and w.isalpha()]
        yield "".join(words)


def leaves(path, text, size, encoder):
    edges = bpe.leaf_bounds(len(text), size)
    for a, b in zip(edges, edges[1:], strict=False):
        head, middle, tail = bpe.leaf_parts(text[a:b])
        yield bpe.Node(bpe.Edge(head, bpe.code(path, head)), encoder.ids(middle), None if tail is None else bpe.Edge(tail, bpe.code(path, tail)))


def test_tree_concatenation_equals_the_library():
    path = bpe.public_path()
    tokenizer = bpe.tokenizer_of(path)
    rng = random.Random(2)
    encoder = bpe.Encoder(path)
    for text in [*random_texts(2500), *(re.sub(r"[^ -~éÉß]", "x", t).replace("<|", "") for t in random_texts(1500, seed=7))]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert bpe.concatenated(path, list(leaves(path, text, rng.choice([5, 17, 40, 90]), encoder))) == want
        assert encoder.ids(text) == want
        n, ids, decoded = encoder.texts_of(want)
        assert (n, ids) == (len(want), " ".join(map(str, want)))
        assert decoded == tokenizer.decode(want, skip_special_tokens=False)


def test_every_plain_character_between_letters():
    path = bpe.public_path()
    tokenizer, encoder = bpe.tokenizer_of(path), bpe.Encoder(path)
    plain = [chr(c) for c in range(0x2100) if not bpe._RARE.search(chr(c))]
    assert len(plain) > 400
    for c in plain:
        text = f"ab{c}cd {c} {c}{c}9{c}x"
        assert encoder.ids(text) == tokenizer.encode(text, add_special_tokens=False).ids, hex(ord(c))


def test_query_over_long_short_null_and_repeated_rows(spark):
    tokenizer = bpe.tokenizer_of(bpe.public_path())
    rng = random.Random(3)
    solid = "".join(rng.choices("abcdefgh", k=3000))
    texts = [None, "", " ", "short one", "short one", solid, solid + " " + solid, "word " * 2000, "é" * 1500, *random_texts(30, seed=4)]
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, bpe.encode_texts(df, leaf_chars=100, digests=True).collect()), key=str)

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for i, t, _ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), digest(" ".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False))))
    assert got == sorted(want, key=str)
    assert bpe.encode_texts(df.limit(0)).collect() == []
