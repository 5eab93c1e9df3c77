"""carestar.sinks"""
