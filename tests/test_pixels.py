import numpy as np
import pytest

from cliploom.edge import pixels


def test_brightness_of_frames():
    white, blue = np.full((2, 3, 3), 255, np.uint8), np.zeros((2, 3, 3), np.uint8)
    blue[..., 0] = 255
    assert pixels.mean_luma(white) == 255.0 and pixels.mean_luma(blue) == 29.0 and pixels.mean_luma(np.zeros((0, 3, 3))) == 0.0
    assert list(pixels.luma_rows("v", iter([white, blue, white, blue, white]), 2)) == [("v", 0, 255.0), ("v", 2, 255.0), ("v", 4, 255.0)]
    assert [r[1] for r in pixels.luma_rows("v", [white, blue], 0)] == [0, 1]


def test_views_are_standardised_and_divided():
    view = np.tile(np.array(pixels.MEAN, np.float32)[:, None, None, None], (1, 4, 2, 2)).copy()
    view[:, 2] += np.array(pixels.SPREAD, np.float32)[:, None, None]
    got = pixels.clip_views(view, 2)
    assert got.shape == (2, 3, 2, 2, 2) and np.allclose(got[0], 0, atol=1e-5) and np.allclose(got[1][:, 0], 1, atol=1e-5) and np.allclose(got[1][:, 1], 0, atol=1e-5)
    assert pixels.clip_views(view).shape == (1, 3, 4, 2, 2)
    with pytest.raises(ValueError):
        pixels.clip_views(view, 3)
