import numpy as np
import pytest

from tellerbook.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture
def random():
    return np.random.default_rng(11)
