"""Fixed values for tests: one documented light curve, listing rows and a listing page."""

import base64

import numpy as np

# 25 epochs as little-endian single-precision numbers.
HMJD = (
    "avJjR2D1Y0eF/GNHawNkR3AJZEdsCmRHWzdkR0k5ZEdHOmRHTT1kR0w/ZEdNQGRHTUNkR01EZEdWRWRHZFFkRzRYZEcwWWRHYHJlR2ByZUdp"
    "c2VHaXNlR3Z7ZUdffGVHX3xlRw=="
)
MAG = (
    "U/6EQc5ahUGrcYVBcG+FQfKUhUHSZYVBJliFQQBphUEcNIVB1AiFQRAqhUHOOoVBJA6FQUFahUEiMoVB9a2FQQ4UhUHWNoVBw0yFQQyYhUF2"
    "jIVBHCGFQWhchUHiQIVBWlyFQQ=="
)
MAGERR = (
    "U65nPEjEazyCz2w8TbVsPMdybjybRGw8dKVrPMppbDzXB2o8UCJoPA6WaTwEVGo8Ql1oPN69azxi8Wk8LKFvPBWfaDzWJmo82SFrPAiYbjww"
    "DW48ODFpPOTWazx0mWo8O9ZrPA=="
)


def numbers(text):
    return [float(x) for x in np.frombuffer(base64.b64decode(text), dtype="<f4")]


def documented_curve():
    hmjd, mag, magerr = numbers(HMJD), numbers(MAG), numbers(MAGERR)
    n = len(hmjd)
    place = (35.6168823242188, 19.0562019348145)
    return (1550215200000003, 2, 1550, 57, *place, n, hmjd, mag, magerr, [0.0] * n, [0] * n)


# Own directory page: sort links in the head, then what stands in the folder.
LISTED = [("curves_7.parquet", "2019-04-30 08:17", "91K"), ("curves_8.parquet", "2019-05-02 23:59", "1.4M"), ("attic/", "2018-12-24 00:01", "-")]


def listing_page(entries=LISTED):
    head = "".join(f'<a href="?sort={k}">{k}</a> ' for k in ("name", "date", "size"))
    rows = "\n".join(f'<i></i><a href="{name}">{name}</a>   {date}   {size}' for name, date, size in entries)
    return f"<html><body><h1>Files</h1><pre>{head}\n{rows}\n</pre></body></html>"


# Sizes as listed: field, size.
LISTED_SIZES = [("field0031", "120K"), ("field0031", "80K"), ("field0031", "1M"), ("field0044", "2.5M"), ("field0044", "500B"), ("field0044", "3G")]
