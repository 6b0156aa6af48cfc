from martloom.sources import buckets_for


def test_buckets_follow_the_rows():
    assert buckets_for(0) == buckets_for(2_000_000) == 8
    assert buckets_for(2_000_001) == 16
    assert buckets_for(216_000_000) == 1024
