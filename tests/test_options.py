import pytest

from mqtable.options import OptionError, QueueOptions, SourceKey, source_keys


def test_defaults():
    o = QueueOptions({})
    assert (o.durable, o.exclusive, o.auto_delete) == (True, False, False)
    assert o.ack_type == "basic" and o.sends_basic_ack and not o.auto_ack
    assert o.parallelism == 1 and o.prefetch_count == 1 and not o.fair_dispatch
    assert o.hosts == "localhost"
    assert o.max_messages_per_partition is None
    assert o.storage_level == "MEMORY_ONLY"
    assert o.remember_seconds is None


def test_bad_values_fall_back_to_defaults():
    o = QueueOptions({"levelParallelism": "junk", "durable": "yes", "prefetchCount": " 5 ", "maxReceiveTime": "x"})
    assert o.parallelism == 1 and o.durable is True and o.prefetch_count == 1
    assert o.max_receive_time_ms == 0


def test_values_that_must_parse_raise():
    with pytest.raises(OptionError):
        QueueOptions({"x-max-length": "ten"})
    with pytest.raises(OptionError):
        QueueOptions({"maxMessagesPerPartition": "many"})
    with pytest.raises(OptionError):
        QueueOptions({"storageLevel": "SOMEWHERE"})


def test_unknown_names_rejected():
    with pytest.raises(OptionError):
        QueueOptions({"vHost": "/"})


def test_ack_types():
    assert QueueOptions({"ackType": "auto"}).auto_ack
    other = QueueOptions({"ackType": "other"})
    assert not other.auto_ack and not other.sends_basic_ack


def test_receive_time_and_remember():
    o = QueueOptions({})
    assert o.receive_time_ms(1000) == 900
    assert QueueOptions({"maxReceiveTime": "250"}).receive_time_ms(1000) == 250
    assert o.remember_batches(1000) == 60
    assert QueueOptions({"rememberDuration": "27000"}).remember_batches(3_600_000) == 8


def test_storage_none_lifted():
    assert QueueOptions({"storageLevel": "NONE"}).batch_storage_level() == "MEMORY_ONLY"


def test_policy_arguments():
    o = QueueOptions({"x-max-length": "100", "x-dead-letter-exchange": "dlx"})
    assert o.policy_arguments() == {"x-max-length": 100, "x-dead-letter-exchange": "dlx"}


def test_source_key_fallback():
    assert source_keys(QueueOptions({})) == []
    keys = source_keys(QueueOptions({"queueName": "q", "routingKeys": "a,b", "hosts": "h1"}))
    assert len(keys) == 1 and keys[0].queue == "q" and keys[0].options == {"hosts": "h1"}
    explicit = [SourceKey("x")]
    assert source_keys(QueueOptions({"queueName": "q"}), explicit) == explicit


def test_merge_source_wins():
    o = QueueOptions({"levelParallelism": "2"}).merged({"levelParallelism": "3"})
    assert o.parallelism == 3


def test_group_options():
    from mqtable.options import group_options

    g = group_options({"queueName": "q", "hosts": "h", "ackType": "auto", "x-max-length": "3", "levelParallelism": "2"})
    assert g == {
        "topology": {"queueName": "q"},
        "connection": {"hosts": "h"},
        "queue": {"ackType": "auto"},
        "policy": {"x-max-length": "3"},
        "consumer": {"levelParallelism": "2"},
    }
    with pytest.raises(OptionError):
        group_options({"bogus": "1"})
