"""carestar.sources"""
