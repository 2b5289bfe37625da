"""Words and numbers that are part of the semantics; each table can be replaced by an argument."""

from __future__ import annotations

# fixed values: the four value columns of a fact row
COLS = ["con_cur", "con_prev", "sep_cur", "sep_prev"]
CURRENT = ["con_cur", "sep_cur"]

# fixed values: character classes
CONSONANTS = "ก-ฮ"
TOKEN = r"\(?-?[\d,]+\.?\d*\)?|(?<![฀-๿\w])-(?![\d฀-๿])"

# fixed values: how units are written, after the word for unit, in parentheses, and bare in a row of column heads; a dash with spaces; years; numbers of notes
UNIT_NAMED = r"หน\s*่?\s*วย\s*[:：]?\s*(พัน|ล้าน)?\s*บาท"
UNIT_PAREN = r"[(（]\s*(พัน|ล้าน)?\s*บาท\s*[)）]"
UNIT_BARE = r"(?<![\d.,])\s(พัน|ล้าน)?บาท(?=\s|$)"
SPACED_DASH = r"\s+[-–—]\s+"
YEAR = r"2[45]\d\d"
NOTE_NUMBER = r"\d+(?:\.\d+)?"

# fixed values: concepts of cash flows that no other statement has, subtotals of cash flows, and a concept that means another one in statements of equity
CF_SUBTOTALS = ["CF_OPERATING", "CF_INVESTING", "CF_FINANCING"]
CF_ONLY = [
    "CF_OPERATING", "CF_INVESTING", "CF_FINANCING", "CASH_NET_CHANGE", "CASH_NET_CHANGE_BEFORE_FX", "CASH_BEGIN", "CASH_END",
    "CF_OPERATING_BEFORE_ITEMS", "CF_TRANSLATION", "CASH_FX_EFFECT", "CASH_RECLASS_HELD_FOR_SALE", "BANK_OVERDRAFT_BEGIN",
]
SE_REMAP = {"DIVIDEND_PAYABLE": "SE_DIVIDEND_DECLARED"}

# fixed values: marks of consolidated and separate statements, and what rows of both are called
CONSOLIDATED, SEPARATE = "งบการเงินรวม", ["เฉพาะกิจการ", "เฉพาะธนาคาร", "เฉพาะบริษัท"]
SIDES = {"con": "งบรวม", "sep": "งบเฉพาะกิจการ"}
BOTH_SIDES, COLUMN = "งบรวม+งบเฉพาะกิจการ", "คอลัมน์"

# fixed values: words of a page's body that tell its statement where no title can be read, in the order in which they are tried
CONTENT = [
    ("CF", ["กระแสเงินสดจากกิจกรรม", "เงินสดสุทธิได้มาจาก", "เงินสดสุทธิใช้ไปใน"]),
    ("SE", ["ยอดคงเหลือ ณ วันที่", "ยอดยกมา"]),
    ("IS", ["รายได้จากการขาย", "ต้นทุนขาย", "กำไรขั้นต้น", "กำไรต่อหุ้น"]),
    ("BS", ["รวมสินทรัพย์", "รวมหนี้สิน", "สินทรัพย์หมุนเวียน", "หนี้สินและส่วนของผู้ถือหุ้น", "หนี้สินและส่วนของเจ้าของ"]),
]

# fixed values: concepts of adjustments to the cash flow
CF_ADJUSTMENTS = ["CASH_FX_EFFECT", "CF_TRANSLATION", "CASH_RECLASS_HELD_FOR_SALE", "BANK_OVERDRAFT_BEGIN"]

# fixed values: equations as (id, addends, total, columns); a question mark begins an addend that may be missing
EQUATIONS = [
    ("assets", ["TOTAL_CURRENT_ASSETS", "TOTAL_NONCURRENT_ASSETS"], "TOTAL_ASSETS", None),
    ("balance", ["TOTAL_LIABILITIES", "TOTAL_EQUITY"], "TOTAL_LIAB_EQUITY", None),
    ("profit_split", ["PROFIT_ATTRIB_PARENT", "PROFIT_ATTRIB_NCI"], "NET_PROFIT", None),
    ("comprehensive_split", ["TCI_ATTRIB_PARENT", "TCI_ATTRIB_NCI"], "TOTAL_COMPREHENSIVE_INCOME", None),
    ("comprehensive", ["NET_PROFIT", "OCI_TOTAL"], "TOTAL_COMPREHENSIVE_INCOME", None),
    ("cash_end", ["CASH_BEGIN", "CASH_NET_CHANGE", *(f"?{a}_AFTER" for a in CF_ADJUSTMENTS)], "CASH_END", None),
    ("cash_change", ["CF_OPERATING", "CF_INVESTING", "CF_FINANCING", *(f"?{a}" for a in CF_ADJUSTMENTS)], "CASH_NET_CHANGE", None),
    ("equity_closing", ["SE_CLOSING"], "TOTAL_EQUITY", CURRENT),
    ("cash_balance", ["CASH", "?BANK_OVERDRAFT_IN_CASH"], "CASH_END", CURRENT),
]

# fixed values: headers of sections, matched by their skeletons as whole lines
SECTIONS = [
    "สินทรัพย์หมุนเวียน", "สินทรัพย์ไม่หมุนเวียน", "หนี้สินหมุนเวียน", "หนี้สินไม่หมุนเวียน",
    "ส่วนของผู้ถือหุ้น", "ส่วนของเจ้าของ", "ทุนจดทะเบียน", "ทุนที่ออกและชำระแล้ว",
    "กำไรขาดทุนเบ็ดเสร็จอื่น", "การแบ่งปันกำไร", "การแบ่งปันกำไร (ขาดทุน)",
    "การแบ่งปันกำไรขาดทุนเบ็ดเสร็จรวม", "การแบ่งปันกำไรขาดทุนเบ็ดเสร็จ",
    "การแบ่งปันกำไรเบ็ดเสร็จรวม", "การแบ่งปันกำไร (ขาดทุน) เบ็ดเสร็จรวม", "การแบ่งปันกำไรเบ็ดเสร็จ",
    "กำไรต่อหุ้น", "กำไร (ขาดทุน) ต่อหุ้น", "กำไรขาดทุนต่อหุ้น", "รายได้", "ค่าใช้จ่าย",
    "กระแสเงินสดจากกิจกรรมดำเนินงาน", "กระแสเงินสดจากกิจกรรมลงทุน", "กระแสเงินสดจากกิจกรรมจัดหาเงิน",
    "ประกอบด้วย", "เงินสดและรายการเทียบเท่าเงินสดในงบกระแสเงินสด ประกอบด้วย",
    "ข้อมูลกระแสเงินสดเปิดเผยเพิ่มเติม", "รายการที่ไม่ใช่เงินสด",
]

# fixed values: page titles by statement, in the order in which they are tried
TITLES = [("SE", "การเปลี่ยนแปลงส่วนของ"), ("CF", "งบกระแสเงินสด"), ("BS", "งบฐานะการเงิน"), ("IS", "งบกำไรขาดทุน")]
LOOSE = ["สินทรัพย", "หนี้สิน"]
NOTES = "หมายเหตุประกอบ"

# fixed values: names of months, tails that don't change a label's meaning
MONTHS = ["มกราคม", "กุมภาพันธ์", "มีนาคม", "เมษายน", "พฤษภาคม", "มิถุนายน", "กรกฎาคม", "สิงหาคม", "กันยายน", "ตุลาคม", "พฤศจิกายน", "ธันวาคม"]
TAILS = ["สุทธิ", "สุทธิจากภาษี"]
BALANCE = ["ยอดคงเหลือ", "ยอดยกมา"]
TOTAL = "รวม"

# fixed values: multipliers of units
UNITS = {"baht": 1.0, "thousand": 1000.0, "million": 1e6}

# fixed values: difficulty labels of truth rows
TRAPS = ["normal", "parentheses", "dash_empty", "subtotal", "note_col", "long_name", "decimal", "small_num", "long_num", "thai_digit", "same_name"]

# fixed values: limits and tolerances
FUZZY_CUTOFF, TRUTH_CUTOFF, TITLE_CUTOFF = 0.90, 0.98, 0.75
EQUATION_TOL, ROLL_TOL, MATRIX_TOL, CELL_TOL, AGREE_TOL = 1.0, 1.0, 1.0, 0.005, 0.5
PREFIXES, HEADER_LINES, MIN_LABEL, MAX_PAGES, TABLE_NUMBERS = 3, 12, 3, 20, 15
