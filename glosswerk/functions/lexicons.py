"""Rule lexicons of clinical notes in Vietnamese, as data.

Every operator takes its lexicon as a parameter; these are the defaults.
Patterns are Java regular expressions; a word boundary is written out as
``B`` and ``E``, since Java's own doesn't know letters of all scripts.
"""

from __future__ import annotations

WORD = r"[\p{L}\p{N}_]"
B, E = rf"(?<!{WORD})", rf"(?!{WORD})"


def words(*alternatives: str) -> str:
    """Pattern of whole words or phrases, in any case."""
    return rf"(?iu){B}(?:{'|'.join(alternatives)}){E}"


#: Headings, in the order in which they are tried: (section, pattern of a line's start).
SECTIONS = [
    ("HISTORY", rf"(?iu)^(?:\d+[.)]\s*)?(?:tiền sử|lịch sử bệnh){E}"),
    ("PRESENT_ILLNESS", rf"(?iu)^(?:\d+[.)]\s*)?(?:bệnh sử|tiền sử bệnh hiện tại|lịch sử bệnh hiện tại){E}"),
    ("MEDICATIONS", rf"(?iu)^(?:thuốc|thuốc trước khi nhập viện|đơn thuốc){E}"),
    ("FAMILY_HISTORY", rf"(?iu)^(?:tiền sử gia đình|gia đình){E}"),
    ("ASSESSMENT", rf"(?iu)^(?:\d+[.)]\s*)?(?:đánh giá|đánh giá tại bệnh viện|chẩn đoán){E}"),
    ("LABS", rf"(?iu)^(?:kết quả xét nghiệm|xét nghiệm){E}"),
    ("PLAN", rf"(?iu)^(?:kế hoạch|điều trị|kế hoạch điều trị){E}"),
    ("PHYSICAL_EXAM", rf"(?iu)^(?:khám lâm sàng|kết quả khám lâm sàng){E}"),
]

#: Detection rules: (type, pattern, pattern of the mention's head or none).
_LAB = r"glucose(?:\s+máu)?|đường\s+huyết|bạch\s+cầu|hemoglobin|creatinin(?:e)?|canxi|calci|natri|kali"
RULES = [
    ("SYMPTOM", words(r"đau\s+ngực", r"khó\s+thở", "sốt", "ho", r"mệt\s+mỏi", r"đánh\s+trống\s+ngực", r"buồn\s+nôn", "nôn", r"đổ\s+mồ\s+hôi"), None),
    ("LAB_RESULT", rf"(?iu){B}(?:{_LAB})(?:\s*(?:là|:)?\s*\d+(?:[.,]\d+)?(?:\s*(?:mmol/L|mg/dL|g/L|G/L|µmol/L|mEq/L))?)?", rf"(?iu)^(?:{_LAB})"),
    ("PATIENT_INFO", words("nam", "nữ", r"thai\s+\d+\s+tuần", r"\d{1,3}\s+tuổi", r"đang\s+mang\s+thai"), None),
]

#: Parts of a medication after its name.
_UNIT = r"mg|mcg|µg|g|ml|mL|unit|đơn\s+vị"
_ROUTE, _TIMES, _FORM = r"po|iv|im|sc|oral|uống|tiêm", r"daily|bid|tid|qid|q\d+h|qam|qhs|prn", "tablet|capsule|suspension|injection|viên|ống"
MEDICATION = {
    "strength": rf"(?iu){B}\d+(?:[.,-]\d+)?\s*(?:{_UNIT}){E}",
    "route": words(_ROUTE),
    "frequency": words(_TIMES),
    "dose_form": words(_FORM),
}
MEDICATION_TAIL = rf"(?iu)^(?:(?:\s+|\s*[,;:]\s*)(?:\d+(?:[.,-]\d+)?\s*(?:{_UNIT})|{_ROUTE}|{_TIMES}|{_FORM}))+"

CUES = {
    "negated": words("không", "chưa", r"không\s+có", r"không\s+ghi\s+nhận", r"âm\s+tính", r"phủ\s+nhận"),
    "historical": words(r"tiền\s+sử", r"trước\s+đây", r"đã\s+từng", r"mãn\s+tính"),
    "planned": words("sẽ", r"dự\s+kiến", r"lên\s+lịch", r"kế\s+hoạch", r"chỉ\s+định"),
    "resolved": words(r"đã\s+hết", r"không\s+còn", r"ổn\s+định", r"cải\s+thiện"),
    "possible": words("nghi", r"nghi\s+ngờ", r"có\s+thể", r"khả\s+năng", r"theo\s+dõi"),
    "family": words("mẹ", "cha", "bố", "anh", "chị", "em", "ông", "bà", r"gia\s+đình", r"người\s+nhà"),
}

#: Types of the output, and the keys that an entity of each has besides text, type and position.
OFFICIAL_TYPES = {"DISEASE": "CHẨN_ĐOÁN", "DRUG": "THUỐC", "SYMPTOM": "TRIỆU_CHỨNG", "LAB_NAME": "TÊN_XÉT_NGHIỆM", "LAB_RESULT": "KẾT_QUẢ_XÉT_NGHIỆM"}
OFFICIAL_KEYS = {"CHẨN_ĐOÁN": ("assertions", "candidates"), "THUỐC": ("assertions", "candidates"), "TRIỆU_CHỨNG": ("assertions",), "TÊN_XÉT_NGHIỆM": (), "KẾT_QUẢ_XÉT_NGHIỆM": ()}
OFFICIAL_ASSERTIONS = {"polarity:NEGATED": "isNegated", "temporality:HISTORICAL": "isHistorical", "experiencer:FAMILY": "isFamily"}

#: Relations by the types of subject and object.
RELATIONS = {
    ("DRUG", "DISEASE"): "DRUG_TREATS_CONDITION",
    ("DRUG", "SYMPTOM"): "DRUG_TREATS_CONDITION",
    ("DISEASE", "SYMPTOM"): "CONDITION_HAS_SYMPTOM",
    ("LAB_RESULT", "DISEASE"): "LAB_ASSOCIATED_WITH_CONDITION",
    ("LAB_RESULT", "SYMPTOM"): "LAB_ASSOCIATED_WITH_SYMPTOM",
}
#: Vocabulary in which entities of a type are looked up.
VOCABULARIES = {"DISEASE": "ICD10", "DRUG": "RXNORM"}
