"""Deterministic stand-ins for model providers, used by the catalogue queries and tests."""

from hashlib import md5

import pandas as pd


def digit(*parts: str) -> str:
    """First hex digit of the digest of the parts."""
    return md5("|".join(parts).encode()).hexdigest()[0]


def grade_by_digest(requests: pd.DataFrame) -> list:
    """Decided, hedged and useless answers and failed calls (None), from the names of model, query and frame."""
    answers = []
    for r in requests.itertuples():
        d = digit(r.model, r.query_id, r.image_id)
        if d in "01234567":
            answers.append("Definitely yes." if digit(r.image_id, r.query_id) in "01234567" else "definitely not")
        elif d in "89ab":
            answers.append("I would say: probably yes")
        elif d in "cd":
            answers.append("Probably No")
        elif d == "e":
            answers.append("yes")
        else:
            answers.append(None)
    return answers


def annotate_by_digest(requests: pd.DataFrame) -> list:
    """Clean, fenced, reasoning, empty and failed answers, by the digest of the image id."""
    answers = []
    for image_id in requests["image_id"]:
        d = digit(image_id)
        if d in "0123":
            answers.append(
                '{"background": "sky", "lighting": "dark", "blur_bucket": "blurry", '
                '"possible_confusers": [" Kite", "bird.", "none"], "camera_angle": "eye_level", '
                '"depth_range": "landscape", "caption": "item ' + image_id + '"}'
            )
        elif d in "4567":
            answers.append(
                '```json\n{"background": "sunset", "blur_bucket": "Sharp", '
                '"possible_confusers": "bird", "depth_range": "mid_range"}\n```'
            )
        elif d in "89ab":
            answers.append(
                '<think>perhaps {"background": "trees"}</think> '
                'So: {"background": "trees"} or rather {"background": "building", '
                '"blur_bucket": "mild", "possible_confusers": ["Plane", "dog"], "extra": {"n": 1}}'
            )
        elif d in "cde":
            answers.append("I cannot tell")
        else:
            answers.append(None)
    return answers


def edit_by_digest(requests: pd.DataFrame) -> list:
    """Statuses of image edits: one in four fails."""
    return ["failed: refused" if k[0] in "048c" else "ok" for k in requests["key"]]
