"""cadenza.functions"""
