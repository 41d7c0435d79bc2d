import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from haulmart.llm import pieces

PATH = pieces.model_path()
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
MODEL = pieces.model(PATH)
LETTERS = st.sampled_from(list(" \n\tabcdeinorst.,'É中😀▁ßéпри") + ["  ", "the", "ing", "<s>", "<0x41>"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(LETTERS, max_size=25).map("".join), max_size=6))
def test_ids_equal_the_library_and_come_back(texts):
    for text, ids in zip(texts, MODEL.encode(texts)):
        assert ids.tolist() == LIBRARY.encode(text)
        assert MODEL.decode(ids.tolist()) == text.replace("▁", " ")


def test_shared_prefixes_give_what_single_words_give():
    words = ["▁the", "▁then", "▁thence", "▁these", "the", "▁", "▁▁", "▁▁▁the", "x" * 40, "▁thé", "\n"]
    together = dict(MODEL.encode_words(words))
    for word in words:
        assert together[word] == dict(MODEL.encode_words([word]))[word] == MODEL.merged(word)


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows, clashing=True)
    got = pieces.round_trips(docs).collect()
    assert len(got) == len(odd_rows) and all(r.round_trip for r in got)
    assert sorted(r.n_tokens for r in got if r.doc_id in (1, 2)) == [0, 0]
    out = pieces.encoded(docs)
    by_id = {r.doc_id: r for r in out.collect()}
    assert by_id[5].token_ids == LIBRARY.encode(by_id[5].text) and by_id[5].n_tokens == len(by_id[5].token_ids)
    assert pieces.round_trips(docs.limit(0)).count() == 0
