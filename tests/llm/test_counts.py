import pytest

from sparkgate.llm import counts
from sparkgate.llm.vocabulary import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def scores():
    return counts.unigram_scores(PATH)


def by_hand(word, scores):
    longest = max(map(len, scores))
    unknown = min(scores.values()) - counts.UNKNOWN_PENALTY
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (best[at][0] + scores[word[at:end]], best[at][1] + 1)
            for at in range(max(0, end - longest), end)
            if word[at:end] in scores
        ]
        if word[end - 1] not in scores:
            options.append((best[end - 1][0] + unknown, best[end - 1][1] + len(word[end - 1].encode())))
        best.append(max(options, key=lambda x: (x[0], -x[1])))
    return best[-1][1]


def total(text, scores):
    return sum(by_hand(counts.WORD_START + word, scores) for word in counts._WORD.findall(text or ""))


def test_frames(given, odd, none, scores):
    for docs in (given("documents").filter("doc_id % 4 = 0"), odd):
        found = sorted(map(tuple, counts.token_counts(docs).collect()), key=str)
        rows = [(r.doc_id, total(r.text, scores)) for r in docs.select("doc_id", "text").collect()]
        assert found == sorted(rows, key=str)
    assert counts.token_counts(none).count() == 0


def test_against_the_librarys_unigram_model(scores):
    tokenizers = pytest.importorskip("tokenizers")
    vocabulary = [("<unk>", 0.0), *scores.items(), *((f"<0x{b:02X}>", -50.0) for b in range(256))]
    model = tokenizers.Tokenizer(tokenizers.models.Unigram(vocabulary, 0, True))
    words = ["▁the", "▁international", "▁xyzzyx", "▁漢字🙂", "▁" + "ab" * 40, "▁ñandú", "▁"]
    assert counts.UnigramCounter(scores).count_all(words).tolist() == [len(model.encode(w).ids) for w in words]


def test_ties_take_fewer_tokens():
    counter = counts.UnigramCounter({"a": -1.0, "b": -1.0, "ab": -2.0, "aba": -4.0})
    assert counter.count_all(["ab", "aba", "", "abab"]).tolist() == [1, 2, 0, 2]
