import pytest

from trolley.settings import Settings


def test_defaults():
    settings = Settings.from_env({})
    assert settings == Settings()
    assert (settings.window, settings.slide) == ("10 minutes", "5 minutes")
    assert (settings.views_threshold, settings.purchases_threshold) == (100, 5)
    assert settings.history_enabled and settings.master is None


def test_values_from_the_environment():
    settings = Settings.from_env(
        {
            "VIEWS_THRESHOLD": "7",
            "ENABLE_PARQUET_SINK": "False",
            "WATERMARK_DELAY": "",
            "SPARK_MASTER": "local[2]",
        }
    )
    assert settings.views_threshold == 7
    assert not settings.history_enabled
    assert settings.watermark is None
    assert settings.master == "local[2]"


@pytest.mark.parametrize("name", ["VIEWS_THRESHOLD", "PURCHASES_THRESHOLD"])
def test_a_threshold_must_be_a_number(name):
    with pytest.raises(ValueError, match=name):
        Settings.from_env({name: "many"})


def test_locations_have_no_default():
    with pytest.raises(ValueError, match="raw_logs_path"):
        Settings().require("raw_logs_path")
