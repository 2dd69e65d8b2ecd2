import os

import pytest

from agentlake.llm.storage import cleaned, materialize, new_folder, shared_folder
from agentlake.llm.substring_dedup import remove_repeats
from agentlake.llm.jaccard_join import near_duplicates
from tests.llm.plain import docs_of, random_texts


def there(spark):
    place = shared_folder(spark).removeprefix("file://")
    return set(os.listdir(place)) if os.path.exists(place) else set()


def test_folders_go_when_a_result_is_written(spark, tmp_path):
    docs, before = docs_of(spark, random_texts(40)), there(spark)
    with cleaned(spark) as made:
        near_duplicates(docs).write.parquet(str(tmp_path / "result"))
        assert len(made) > 3 and there(spark) > before
    assert there(spark) == before and spark.read.parquet(str(tmp_path / "result")).count() == 40
    with pytest.raises(ZeroDivisionError):
        with cleaned(spark):
            materialize(docs, "kept")
            1 / 0
    assert there(spark) == before


def test_folders_stay_without_being_asked(spark):
    before = there(spark)
    materialize(docs_of(spark, ["a"]), "kept")
    assert len(there(spark) - before) == 1 and new_folder(spark, "x") != new_folder(spark, "x")
    assert remove_repeats(docs_of(spark, ["a"])).count() == 1
