"""What Python workers keep between tasks."""

import gc
import weakref

import public_tokenizers

from wayfield.llm import common, packing, toxicity


class Shared:
    value = ({"a": 1}, {"idiot": 1.0}, 0.0)


def task(owner=""):
    return list(common.trimmed(lambda batches: batches, owner)([1, 2]))


def test_models_do_not_outlive_their_operator():
    shared = Shared()
    model = weakref.ref(toxicity._loaded(shared))
    assert task(toxicity.OWNER) == [1, 2] and toxicity._loaded(shared) is model()
    task()  # of another operator
    gc.collect()
    assert model() is None


def test_a_worker_holds_one_model():
    first = weakref.ref(toxicity._loaded(Shared()))
    path = public_tokenizers.path("word_bpe_49k.json")
    enc = packing.encoder(path)
    assert packing.encoder(str(path)) is enc
    gc.collect()
    assert first() is None
    assert common.trimmed_group(lambda key, table: table)(1, "t") == "t" and not common._HELD
