import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hourglass.session import get_session

    s = get_session(master="local[4]", shuffle_partitions=4, app="hourglass-tests")
    # tests own their checkpoint folder; a cluster session names a shared one
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hourglass-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def icu_spec():
    from hourglass.spec import PanelSpec

    return PanelSpec(id_col="PatientID", time_col="Time", target_col="label",
                     static=("Age", "Gender", "Height", "Weight_static"),
                     dynamic=("HR", "MechVent", "Temp", "Weight"),
                     binary=("Gender", "MechVent"), log=("HR",),
                     ranges={"Temp": (30, 45), "Height": (50, 250)}, n_steps=49)
