"""Rule configuration: field labels, known values, digit threshold and plate prefixes."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

# fixed values: built-in field labels
DEFAULT_FIELDS = {
    "手机号": ["手机号", "手机号码", "手机", "联系电话", "联系方式", "电话", "mobile", "phone"],
    "身份证号": ["身份证号", "身份证号码", "身份证", "证件号码", "证件号", "id_card", "idcard"],
    "车牌号": ["车牌", "车牌号", "车牌号码", "车辆号牌", "plate", "license_plate"],
    "银行卡号": ["银行卡号", "银行卡", "银行账号", "卡号", "bank_card", "bank_account", "card_number"],
}
# fixed values: province signs of the built-in plate prefixes, each with every letter A-Z
PROVINCES = "京津沪渝冀豫云辽黑湘皖鲁新苏浙赣鄂桂甘晋蒙陕吉闽贵粤青藏川宁琼"
PLATE_SUFFIXES = "挂学警港澳使领"
DEFAULT_MIN_DIGITS = 7
CONFIG_KEYS = ("fields", "known_values", "min_continuous_digits", "enable_continuous_digits",
               "plate_prefixes_file")


@dataclass(frozen=True)
class Rules:
    fields: dict = field(default_factory=dict)
    known_values: dict = field(default_factory=dict)
    min_continuous_digits: int | None = None
    enable_continuous_digits: bool | None = None
    plate_prefixes: tuple = ()

    def __post_init__(self):
        n, on = self.min_continuous_digits, self.enable_continuous_digits
        if n is not None and (type(n) is not int or n < 1):
            raise ValueError("min_continuous_digits must be a positive integer")
        if on is not None and type(on) is not bool:
            raise ValueError("enable_continuous_digits must be a boolean")
        for values in (self.fields, self.known_values):
            check_string_lists(values)
        for prefix in self.plate_prefixes:
            if not isinstance(prefix, str) or not re.fullmatch("[一-鿿][A-Z]", prefix):
                raise ValueError("a plate prefix is one Han character and one capital letter")

    @property
    def digit_threshold(self) -> int | None:
        if self.enable_continuous_digits is False:
            return None
        return DEFAULT_MIN_DIGITS if self.min_continuous_digits is None else self.min_continuous_digits

    def all_fields(self) -> dict[str, list[str]]:
        merged = {c: list(a) for c, a in DEFAULT_FIELDS.items()}
        for category, labels in self.fields.items():
            merged.setdefault(category, []).extend(labels)
        return merged

    def plate_letters(self) -> dict[str, str]:
        if not self.plate_prefixes:
            return {p: "A-Z" for p in PROVINCES}
        letters: dict[str, set] = {}
        for prefix in self.plate_prefixes:
            letters.setdefault(prefix[0], set()).add(prefix[1])
        return {p: "".join(sorted(s)) for p, s in sorted(letters.items())}


def check_string_lists(values) -> None:
    ok = isinstance(values, dict) and all(
        isinstance(k, str) and k and isinstance(v, (list, tuple))
        and all(isinstance(x, str) and x for x in v)
        for k, v in values.items())
    if not ok:
        raise ValueError("fields and known_values map names to lists of non-empty strings")


def load_plate_prefixes(path: str | Path) -> tuple:
    prefixes = json.loads(Path(path).read_text(encoding="utf-8-sig"))
    if not isinstance(prefixes, list) or not prefixes:
        raise ValueError("the plate prefix file must hold a non-empty list")
    return tuple(prefixes)


def load_rules(path: str | Path | None) -> Rules:
    """Driver-side JSON configuration with a closed key set; relative lexicon paths follow the file."""
    if path is None:
        return Rules()
    path = Path(path)
    config = json.loads(path.read_text(encoding="utf-8-sig"))
    if not isinstance(config, dict) or set(config) - set(CONFIG_KEYS):
        raise ValueError("the rule configuration has unsupported keys")
    if "enable_continuous_digits" in config and type(config["enable_continuous_digits"]) is not bool:
        raise ValueError("enable_continuous_digits must be a boolean")
    plates = config.get("plate_prefixes_file")
    return Rules(
        fields=config.get("fields") or {},
        known_values=config.get("known_values") or {},
        min_continuous_digits=config.get("min_continuous_digits"),
        enable_continuous_digits=config.get("enable_continuous_digits"),
        plate_prefixes=load_plate_prefixes(path.parent / plates) if plates is not None else (),
    )
