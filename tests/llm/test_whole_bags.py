"""The fits bound the number of documents, not what they see of one."""

import numpy as np
import pyarrow as pa

from meterhawk.llm import quality, toxicity

TEXT = " ".join(f"word{'abcdefg'[i % 7]}{i}" for i in range(9_000)) + " idiot"


def _batch(text):
    return pa.RecordBatch.from_arrays([pa.array([1]), pa.array([1]), pa.array([text])], names=["doc_id", "label", "text"])


def test_every_window_of_a_long_text_is_passed():
    (out,) = toxicity._sampled(iter([_batch(TEXT.encode())]))
    windows = np.frombuffer(out.column("windows")[0].as_py(), np.uint8).reshape(-1, toxicity.SPAN)
    assert len(windows) >= 9_001 and len(windows) == len(toxicity._layout(TEXT.encode())[1])
    assert [ord(c) - 96 for c in "idiot"] in windows[:, 1:6].tolist()


def test_every_passage_of_a_long_text_is_passed():
    (out,) = quality._encoded(iter([_batch(TEXT)]))
    bag = np.frombuffer(out.column("bag")[0].as_py(), np.float32).reshape(-1, quality.FEATURES)
    assert len(bag) > 48 and (bag == quality.encode_passages(TEXT)).all()
