"""carestar.streaming"""
