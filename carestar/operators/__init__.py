"""carestar.operators"""
