"""A detector for the given tables, which have vectors and no images."""

import json
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class StripeDetector:
    """An image is a JSON array of `size` numbers; each of its eight stripes is a box with its maximum as the confidence."""

    size: int = 64

    def load(self):
        return np.arange(8)

    def decode(self, payload):
        try:
            image = np.asarray(json.loads(payload), dtype=np.float32)
        except (ValueError, TypeError):
            return None
        return image if image.shape == (self.size,) else None

    def detect(self, model, images):
        confidences = np.stack(images).reshape(len(images), len(model), -1).max(axis=2)
        return [[(int(c), float(p)) for c, p in zip(model, row)] for row in confidences]
