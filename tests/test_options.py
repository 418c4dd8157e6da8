from __future__ import annotations

import pytest

from doclog.sources import collection_options, collection_path, log_options, log_path, topic_address

COLLECTION = {"regionUrl": "/r/", "fabric": "_system", "collection": "c"}
LOG = {"regionUrl": "/r", "fabric": "_system", "tenant": "t", "stream": "s",
       "replication": "GLOBAL", "subscriptionName": "me"}


@pytest.mark.parametrize("name", list(COLLECTION))
def test_collection_needs(name):
    for missing in ({k: v for k, v in COLLECTION.items() if k != name}, {**COLLECTION, name: ""}):
        with pytest.raises(ValueError, match=f"Option '{name}' is required"):
            collection_options(missing)


@pytest.mark.parametrize("name", list(LOG))
def test_log_needs(name):
    missing = {k: v for k, v in LOG.items() if k != name}
    with pytest.raises(ValueError, match=f"Option '{name}' is required"):
        log_options(missing)
    if name == "subscriptionName":
        log_options(missing, write=True)


def test_names_ignore_case_and_addresses():
    options = log_options({k.upper(): v for k, v in LOG.items()})
    assert topic_address(options) == "persistent://t/c8global._system/c8globals.s"
    assert log_path(options) == "/r/t/c8global._system/c8globals.s"
    own = log_options({**LOG, "replication": "local", "isCollectionStream": "True"})
    assert topic_address(own) == "persistent://t/c8local._system/s"
    assert collection_path(collection_options(COLLECTION)) == "/r/fabric/_system/c"


def test_replication():
    with pytest.raises(ValueError, match="takes local or global"):
        log_options({**LOG, "replication": "both"})
    with pytest.raises(ValueError, match="needs replication local"):
        log_options({**LOG, "isCollectionStream": True})
    with pytest.raises(ValueError, match="only be read"):
        log_options({**LOG, "replication": "local", "isCollectionStream": True}, write=True)


@pytest.mark.parametrize("size, ok", [(0, False), (1, True), (10000, True), (10001, False)])
def test_batch_size(size, ok):
    options = collection_options({**COLLECTION, "batchSize": size})
    if ok:
        assert options.batch_size == size
    else:
        with pytest.raises(ValueError, match="Batch size"):
            options.batch_size
    assert collection_options(COLLECTION).batch_size == 100
