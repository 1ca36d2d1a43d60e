"""What the rules pay and print, stated once more for the oracle.

Fixed values, written down from the rules themselves and not taken from the package.
"""

from __future__ import annotations

# Rule: code and rate.
TERMS: dict[str, tuple[str, int]] = {
    "r01": ("C1.1", 100),
    "r02": ("C1.3", 100),
    "r03": ("C1.5", 100),
    "r04": ("C1.5", 100),
    "r05": ("C1.8", 200),
    "r06": ("C1.9", 100),
    "r07": ("I1.1", 100),
    "r08": ("I2.1", 300),
    "r09": ("I2.2", 400),
    "r10": ("I2.3", 400),
    "r11": ("I2.4", 300),
    "r12": ("I2.5", 150),
    "r13": ("I2.7", 500),
    "r14": ("I2.8", 1000),
    "r15": ("C3.4", 100),
    "r16": ("C3.5", 75),
    "r17": ("C3.6", 50),
    "r18": ("C4.1", 250),
    "r19": ("C4.1", 250),
    "r20": ("C4.1", 250),
    "r21": ("C4.7", 50),
    "r22": ("C7.1", 10),
    "r23": ("I1.4", 300),
    "r24": ("I1.5", 200),
    "r25": ("C2.4", 100),
    "r26": ("I8.1", 500),
    "r27": ("I8.13", 300),
    "r28": ("I8.14", 2000),
    "r29": ("I8.15", 3000),
    "r30": ("I8.17", 1000),
}

# Rules on everyone's people, whoever runs the report.
UNSCOPED = ("r05", "r07", "r08", "r09")

# Monthly services and their rates.
MONTHLY = {
    "PC1.1": 300,
    "PC1.2": 300,
    "PC1.3": 300,
    "PC1.4": 300,
    "PC1.5": 300,
    "PI1.1": 150,
    "PC1.6": 200,
    "PC1.7": 150,
}

# Columns of the form in print order, and their headings.
FORM = {
    "s_no": "क्र. स.",
    "code": "सेवा/कार्य का कोड",
    "rate": "प्रोत्साहन राशि का सामान्य दर",
    "beneficiary_count": "लाभार्थियो की संख्या",
    "total_claim_amount": "दावा की गयी राशि",
    "work_completion_date": "कार्य पूर्ण की अंतिम तिथि",
    "location_of_health_centre": "प्रखंड का नाम / जिला अस्पताल",
    "registration_code": "पंजी का कोड",
    "section": "खंड",
    "date_of_registration": "पंजी में अंकित दिनांक",
    "asha_signature": "आशा फैसिलिटेटर का हस्ताक्षर",
}

INTRO_NAME = "आशा का नाम"
INTRO_CENTRE = "स्वास्थ केंद्र का नाम ___________"
INTRO_MONTH = "माह-वर्ष जिसके लिए प्रत्साहन राशि का दावा किया गया है --"

MONTH_NAMES = "जनवरी फरवरी मार्च अप्रैल मई जून जुलाई अगस्त सितंबर अक्टूबर नवंबर दिसंबर".split()
