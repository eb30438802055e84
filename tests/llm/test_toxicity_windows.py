"""Insults that are parted by characters of several bytes or by punctuation, or that stand late in a run."""

import numpy as np
import pytest

from meterhawk.llm import toxicity

WORDS = "river calm valley evening people water stone light under house garden winter summer letter window paper music table".split()
FORMS = {
    "bullets": "i•d•i•o•t", "zero-width spaces": "i​d​i​o​t", "hyphens between spaces": "i - d - i - o - t",
    "emoji": "i🙂d🙂i🙂o🙂t", "dashes": "i—d—i—o—t", "after brackets": "(((((((((idiot", "after slashes": "read/this/idiot",
    "late in a run": "thewaterandthestoneidiotinthegarden",
}


def _windows(text):
    symbols, starts, sentence = toxicity._layout(text.encode())
    padded = np.concatenate([symbols, np.zeros(toxicity.SPAN, symbols.dtype)])
    return padded[starts[:, None] + np.arange(toxicity.SPAN)], sentence


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    clean = [" ".join(rng.choice(WORDS, 30)) + ". " + "".join(rng.choice(WORDS, 6)) + "/" + rng.choice(WORDS) for _ in range(120)]
    toxic = [" ".join([*rng.choice(WORDS, 12), str(rng.choice(["idiot", "moron", "idiot."])), *rng.choice(WORDS, 12)]) for _ in range(60)]
    parts = [_windows(text) for text in clean + toxic]
    of_doc = np.repeat(np.arange(len(parts)), [len(w) for w, _ in parts])
    labels = np.repeat([0, 1], [len(clean), len(toxic)])
    return toxicity.fit_windows(np.concatenate([w for w, _ in parts]), np.concatenate([s for _, s in parts]), of_doc, labels, np.ones(len(parts)))


@pytest.mark.parametrize("form", FORMS)
def test_planted_insult_is_found(model, form):
    said = f"the calm river under the house {FORMS[form]} winter light. the paper on the table."
    plain = said.replace(FORMS[form], "letter")
    hit, miss = model.scores([said.encode(), plain.encode()])
    assert hit >= toxicity.TOXIC > miss


def test_every_letter_is_in_a_window_and_characters_are_symbols():
    text = "x" + "abcdefg" * 9 + "/pqr, 日本語の長い文章には空白がありません"
    symbols, starts, sentence = toxicity._layout(text.encode())
    held = set((starts[:, None] + np.arange(toxicity.REACH)).ravel())
    # A triple needs two more letters after its first.
    letters = [at for at in range(len(symbols) - 2) if symbols[at] not in (0, toxicity.BOUNDARY)]
    assert set(letters) <= held and (np.diff(sentence) >= 0).all()
    for parted in ("i•d", "i🙂d", "i--d"):
        assert len(toxicity._layout(parted.encode())[0]) == 4
    assert (toxicity._layout("i - d".encode())[0] == toxicity._layout(b"i d")[0]).all()
    assert (toxicity._layout("i​d".encode())[0] == toxicity._layout(b"id")[0]).all()
    assert len(toxicity._layout(b"((( 12 --")[1]) == 0


SYLLABLES = {"common": "than ing ou re st ed ble er on ha".split(), "rare": "ción ra ue ga as mi te ado lla je".split()}
INSULTS = {"common": ["idiot", "clown", "scum"], "rare": ["bomente", "boco"]}


def _documents(rng, tongue, toxic, n):
    """Documents of one tongue. The common tongue's clean ones name no insult; of the rare tongue's, one in five does, once."""
    out = []
    for _ in range(n):
        words = ["".join(rng.choice(SYLLABLES[tongue], rng.integers(1, 4))) for _ in range(rng.integers(60, 200))]
        said = rng.integers(3, 7) if toxic else int(tongue == "rare" and rng.random() < 0.2)
        for at in rng.choice(len(words), said, replace=False):
            words[at] = str(rng.choice(INSULTS[tongue])) + (str(rng.choice(SYLLABLES[tongue])) if tongue == "rare" else "")
        for at in range(12, len(words), 13):
            words[at] += "."
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_rare_tongue_is_learnt_on_every_draw(seed):
    """Held out, each tongue's toxic documents are found, though clean ones of the rare tongue name its insults."""
    rng = np.random.default_rng(seed)
    sizes = [("common", 0, 240), ("common", 1, 60), ("rare", 0, 80), ("rare", 1, 20)]
    drawn = [(tongue, bad, _documents(rng, tongue, bad, 2 * n)) for tongue, bad, n in sizes]
    train = [(bad, text) for _, bad, texts in drawn for text in texts[: len(texts) // 2]]
    parts = [_windows(text) for _, text in train]
    of_doc = np.repeat(np.arange(len(parts)), [len(w) for w, _ in parts])
    fitted = toxicity.fit_windows(
        np.concatenate([w for w, _ in parts]), np.concatenate([s for _, s in parts]), of_doc,
        np.array([bad for bad, _ in train]), np.ones(len(train)), seed,
    )
    for _, bad, texts in drawn:
        unseen = [text.encode() for text in texts[len(texts) // 2 :]]
        flagged = np.mean(np.array(fitted.scores(unseen)) >= toxicity.TOXIC)
        assert flagged >= 0.9 if bad else flagged <= 0.05


def test_document_features_do_not_depend_on_clean_length():
    quiet = np.full(5, -0.9, np.float32)
    short = toxicity._document_features(quiet[:1], np.zeros(1, int))
    assert (short == toxicity._document_features(quiet, np.arange(5))).all()
    assert (short == toxicity._document_features(quiet[:0], np.empty(0, int))).all()
    loud = toxicity._document_features(np.array([-1, 2, 1, -1], np.float32), np.array([0, 0, 1, 2]))
    assert np.allclose(loud, [2, 1, toxicity.FLOOR, np.log(4), np.log(76)])
