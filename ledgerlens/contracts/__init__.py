"""Declarative data contracts evaluated as Spark expressions."""

from ledgerlens.contracts.contract import Contract, ContractViolation, Field, split_by_rules

__all__ = ["Contract", "ContractViolation", "Field", "split_by_rules"]
