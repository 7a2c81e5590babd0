"""Hand-built OCR exports of the three engines from plain lines."""

import json

MC = ["HARBOUR CLINIC PTE LTD", "MEDICAL CERTIFICATE", "Patient Name:", "TAN WEI MING", "NRIC/FIN:", "S1234567A", "Date of Birth: 14/03/1988", "Address", "1 Example Road", "Diagnosis: Acute gastroenteritis", "ICD-10 Code: A09", "is unfit for duty for a period of 2 (two) days", "Date of Issue: 2026-09-02", "Discharge Date / Time: 2 Sep 2026, 3:15 pm", "Submission Date/Time:", "02/09/2026 11:05"]
RECEIPT = ["NOVENA WELLNESS CENTRE", "OFFICIAL RECEIPT", "TAX INVOICE", "GST Reg No. M2-1234567-8", "Name", "SITI NURHALIZA", "DOB: 31/02/1992", "GST 9%: S$7.70", "TOTAL", "S$93.20"]
REFERRAL = ["Fullerton Health panel", "REFERRAL LETTER", "Kindly review", "Referring Provider: Harbour Clinic", "Total Amount Paid: SGD 850.00", "Approved Amount: EUR 1,000.00", "Signature"]


def envelope(engine, raw, country="SG", **extra):
    source = {"original_filename": "x.pdf", "mime_type": "application/pdf", "source_sha256": "ab", "country_code": country}
    return json.dumps({"source": source, "ocr": {"engine": engine, "engine_version": "1", "processed_at": "2026-09-02T03:12:44Z"}, "raw_output": raw} | extra).encode()


def textract(pages, confidence=95.0, **changes):
    blocks = []
    for number, lines in enumerate(pages, 1):
        blocks.append({"BlockType": "PAGE", "Id": f"p{number}", "Page": number, "Relationships": [{"Type": "CHILD", "Ids": [f"p{number}l{i}" for i in range(len(lines))]}]})
        for i, text in enumerate(lines):
            box = {"Left": 0.1, "Top": i / 100, "Width": 0.5, "Height": 0.01}
            blocks.append({"BlockType": "LINE", "Id": f"p{number}l{i}", "Page": number, "Text": text, "Confidence": confidence, "Geometry": {"BoundingBox": box}} | changes)
            blocks.append({"BlockType": "WORD", "Id": f"w{i}"})
    return {"Blocks": blocks}


def tesseract(pages, conf=96.0):
    rows = []
    for number, lines in enumerate(pages, 1):
        rows.append((1, number, 0, 0, 0, 0, 0, 1000, 2000, -1, ""))
        for i, text in enumerate(lines):
            rows.append((4, number, 1, 1, i, 100, 20 * i, 500, 18, -1, ""))
            for j, word in enumerate(text.split()):
                rows.append((5, number, 1, 1, i, 100 + 50 * j, 20 * i, 40, 18, conf, f" {word} "))
            rows.append((5, number, 1, 1, i, 0, 0, 1, 1, -1, "  "))
    names = ("level", "page_num", "block_num", "par_num", "line_num", "left", "top", "width", "height", "conf", "text")
    return {n: [r[k] for r in rows] for k, n in enumerate(names)}


def azure(pages, confidence=0.9, unit="pixel"):
    out = []
    for number, lines in enumerate(pages, 1):
        at, ls, ws = 0, [], []
        for i, text in enumerate(lines):
            ls.append({"content": text, "polygon": [100, 20 * i, 600, 20 * i, 600, 20 * i + 18, 100, 20 * i + 18], "spans": [{"offset": at, "length": len(text)}]})
            for k, word in enumerate(text.split()):
                ws.append({"content": word, "confidence": confidence, "span": {"offset": at + k, "length": len(word)}})
            at += len(text) + 1
        out.append({"pageNumber": number, "width": 1000, "height": 2000, "unit": unit, "lines": ls, "words": ws})
    return {"analyzeResult": {"content": "x", "pages": out[::-1]}}


def files(spark, contents):
    return spark.createDataFrame([(n, None if c is None else bytearray(c)) for n, c in contents.items()], "filename string, content binary")
